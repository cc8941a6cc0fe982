"""S9 — calendar dimension generator.

One row per day between inclusive bounds. Bounds are either literals or come
from data (a one-row aggregate used as a scalar subquery, so no driver
round-trip and no cross join). The row count is the number of days, bounded by
the time span and independent of data volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalloy.functions.dates import date_key

CALENDAR_COLUMNS = [
    "date_key", "full_date", "year", "quarter", "month",
    "month_start", "quarter_start", "is_month_end", "is_quarter_end",
]


def calendar_columns(d: Column) -> list[Column]:
    month_end = d == F.last_day(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.trunc(d, "MM").alias("month_start"),
        F.trunc(d, "quarter").alias("quarter_start"),
        month_end.alias("is_month_end"),
        (month_end & F.month(d).isin(3, 6, 9, 12)).alias("is_quarter_end"),
    ]


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Daily calendar over ``[bounds.lo, bounds.hi]`` of a one-row DataFrame of DATEs."""
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def calendar(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Daily calendar between literal bounds (inclusive)."""
    bounds = spark.range(1).select(F.to_date(F.lit(str(start))).alias("lo"), F.to_date(F.lit(str(end))).alias("hi"))
    return calendar_between(bounds)


def calendar_for(df: DataFrame, date_col: str | Column, *, whole_years: bool = True) -> DataFrame:
    """Calendar covering every date in ``df[date_col]``; whole calendar years by default."""
    d = F.to_date(F.col(date_col) if isinstance(date_col, str) else date_col)
    b = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    if whole_years:
        b = b.select(F.trunc("lo", "year").alias("lo"),
                     F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("hi"))
    return calendar_between(b)
