"""Gold builds: calendar dim, forward-filled macro strip, as-of fill (S9, P6, P7, N2, N3,
A6, J10, J11, R6, A7, M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.functions.dates import date_key
from medalloy.operators import timeseries as ts
from medalloy.plans.registry import plan
from medalloy.plans.tables import SERIES, macro_observations, read
from medalloy.sources.calendar import calendar_for

_SERIES_VALUES = ", ".join(f"('{k}')" for k in SERIES)
_PIVOT_SQL = ",\n       ".join(f"max(CASE WHEN series_id = '{k}' THEN value END) AS {v}" for k, v in SERIES.items())


@plan("calendar_dim", "S9", oracle="""
WITH b AS (SELECT date_trunc('year', min(CAST(o_orderdate AS DATE))) AS lo,
                  CAST(date_trunc('year', max(CAST(o_orderdate AS DATE))) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS hi
           FROM orders),
d AS (SELECT CAST(g AS DATE) AS full_date FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g))
SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
       full_date,
       CAST(year(full_date) AS INTEGER) AS year,
       CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month,
       CAST(date_trunc('month', full_date) AS DATE) AS month_start,
       CAST(date_trunc('quarter', full_date) AS DATE) AS quarter_start,
       full_date = last_day(full_date) AS is_month_end,
       full_date = last_day(full_date) AND month(full_date) IN (3, 6, 9, 12) AS is_quarter_end
FROM d
""")
def calendar_dim(spark, sf_dir):
    """Daily calendar spanning the order dates, whole years."""
    return calendar_for(read(spark, sf_dir, "orders"), "o_orderdate")


def _monthly_last(spark, sf_dir):
    obs = macro_observations(spark, sf_dir).where(F.col("series_id").isin(list(SERIES)))  # P6
    return ts.last_in_period(obs, "series_id", "obs_date", "value", tiebreak="o_orderkey",
                             period_col="month_end")  # N2


def _spine(spark, last):
    # Global bounds as scalar subqueries (no driver round-trip);
    # J10 as a per-series generator over the month range (no cross join).
    lo = last.agg(F.min("month_end")).scalar()
    hi = last.agg(F.max("month_end")).scalar()
    series = spark.createDataFrame([(k,) for k in SERIES], "series_id string")  # S8
    return ts.month_spine(series, lo, hi).withColumn("date_key", date_key("month_end"))


_MACRO_CTE = f"""
WITH obs AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS obs_date, o_orderkey, o_totalprice AS value
  FROM orders WHERE o_orderpriority IN ({", ".join(f"'{k}'" for k in SERIES)})),
last AS (
  SELECT series_id, month_end, obs_date, value FROM (
    SELECT series_id, last_day(obs_date) AS month_end, obs_date, value,
           row_number() OVER (PARTITION BY series_id, last_day(obs_date) ORDER BY obs_date DESC, o_orderkey DESC) AS rn
    FROM obs) WHERE rn = 1),
b AS (SELECT min(month_end) AS lo, max(month_end) AS hi FROM last),
spine AS (
  SELECT s.series_id, last_day(CAST(g AS DATE)) AS month_end
  FROM (VALUES {_SERIES_VALUES}) s(series_id), b,
       generate_series(CAST(date_trunc('month', b.lo) AS TIMESTAMP), CAST(date_trunc('month', b.hi) AS TIMESTAMP), INTERVAL 1 MONTH) t(g)),
filled AS (
  SELECT s.series_id, s.month_end, l.value, l.obs_date
  FROM spine s ASOF LEFT JOIN last l ON s.series_id = l.series_id AND s.month_end >= l.month_end)
"""


@plan("macro_strip", "P6 N2 A6 P7 S8 J10 J11 N3 R6 A7 M4", oracle=_MACRO_CTE + f"""
SELECT CAST(year(month_end) * 10000 + month(month_end) * 100 + day(month_end) AS INTEGER) AS date_key,
       month_end,
       {_PIVOT_SQL}
FROM filled GROUP BY month_end
""")
def macro_strip(spark, sf_dir):
    """Forward-filled national series strip: one row per month-end, one column per series."""
    last = _monthly_last(spark, sf_dir)
    spine = _spine(spark, last)
    filled = ts.asof_fill(spine, last, "series_id", spine_date="month_end", obs_date="month_end", values="value")
    return ts.pivot_wide(filled, ["date_key", "month_end"], "series_id", "value", SERIES)


@plan("asof_fill", "J11 N3 T9", oracle=_MACRO_CTE + """
SELECT series_id, month_end, value, obs_date AS source_obs_date FROM filled
""")
def asof_fill_long(spark, sf_dir):
    """Long as-of fill: every series × month-end with the carried value and its source date."""
    last = _monthly_last(spark, sf_dir)
    spine = _spine(spark, last).drop("date_key")
    return ts.asof_fill(spine, last, "series_id", spine_date="month_end", obs_date="month_end",
                        values=["value", "obs_date"], carry_date_as=None).withColumnRenamed("obs_date", "source_obs_date")


@plan("asof_metro", "J11 N2 T9", oracle="""
WITH obs AS (
  SELECT o_custkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(o_orderdate AS DATE) AS d,
         o_orderkey, o_totalprice FROM orders),
last AS (SELECT geo_id, month_end, value FROM (
  SELECT geo_id, month_end, o_totalprice AS value,
         row_number() OVER (PARTITION BY geo_id, month_end ORDER BY d DESC, o_orderkey DESC) rn FROM obs) WHERE rn = 1),
b AS (SELECT min(month_end) AS lo, max(month_end) AS hi FROM last),
g AS (SELECT DISTINCT geo_id FROM last),
spine AS (SELECT g.geo_id, last_day(CAST(t.m AS DATE)) AS month_end FROM g, b,
          generate_series(CAST(date_trunc('month', b.lo) AS TIMESTAMP), CAST(date_trunc('month', b.hi) AS TIMESTAMP), INTERVAL 1 MONTH) t(m))
SELECT s.geo_id, s.month_end, l.value, l.month_end AS source_month
FROM spine s ASOF LEFT JOIN last l ON s.geo_id = l.geo_id AND s.month_end >= l.month_end
""")
def asof_metro(spark, sf_dir):
    """Per-customer ("metro") forward fill over the global month range: sparse series, so the
    as-of carries values across many empty months. Spine = entities × months (the result)."""
    o = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("geo_id"), F.to_date("o_orderdate").alias("d"), "o_orderkey", "o_totalprice")
    last = ts.last_in_period(o, "geo_id", "d", "o_totalprice", tiebreak="o_orderkey", period_col="month_end")
    last = last.select("geo_id", "month_end", F.col("o_totalprice").alias("value"))
    lo = last.agg(F.min("month_end")).scalar()
    hi = last.agg(F.max("month_end")).scalar()
    spine = ts.month_spine(last.select("geo_id").distinct(), lo, hi)
    obs = last.withColumn("source_month", F.col("month_end"))
    return ts.asof_fill(spine, obs, "geo_id", spine_date="month_end", obs_date="month_end",
                        values=["value", "source_month"])
