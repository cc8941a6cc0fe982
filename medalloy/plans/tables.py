"""Reading the driver tables and the analogue views built from them.

Analogue map (reference → test tables):
  census region → region, state → nation, metro → customer,
  macro series → orders by o_orderpriority, monthly metro fact → orders by customer × month,
  second feed → lineitem by customer × month, hazard ⟗ climate → labels ⟗ documents,
  task attempts / step log → events, raw text files → documents / pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The five macro "series" (order priorities) and their wide column names.
SERIES = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "not_specified",
    "5-LOW": "low",
}


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations of five national series: (series_id, obs_date, o_orderkey, value)."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("series_id"),
        F.to_date("o_orderdate").alias("obs_date"),
        "o_orderkey",
        F.col("o_totalprice").alias("value"),
    )


def customer_period(spark: SparkSession, sf_dir: str, period: str = "month") -> DataFrame:
    """Orders pre-aggregated to (customer, period start): exact DECIMAL sum and count.

    Aggregating before any join to the customer dimension keeps a customer that holds a
    large share of all orders from pushing its raw rows through one join partition.
    """
    o = read(spark, sf_dir, "orders")
    start = F.trunc(F.to_date("o_orderdate"), "MM" if period == "month" else period)
    return (o.groupBy(F.col("o_custkey").alias("c_custkey"), start.alias("p_start"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"), F.count(F.lit(1)).alias("n")))


def nation_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation × month-end order value (entity × period grain, one row each)."""
    cp = customer_period(spark, sf_dir, "month")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = cp.join(c, "c_custkey")
    return (j.groupBy(F.col("c_nationkey").alias("geo_id"), F.last_day("p_start").alias("month_end"))
             .agg(F.sum("v").cast("double").alias("value"), F.sum("n").alias("n_orders")))
