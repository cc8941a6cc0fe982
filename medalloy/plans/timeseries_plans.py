"""Time-series plans.

Customers are sparse "metros" (about ten orders over ~80 months), so calendar gaps occur
naturally: prior-period lookups must return NULL across them, never the previous row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.functions.dates import date_key, month_ordinal, quarter_ordinal
from medalloy.operators import timeseries as ts
from medalloy.operators.sizing import broadcast_if_small
from medalloy.plans.registry import plan
from medalloy.plans.tables import customer_period, nation_monthly, read
from medalloy.sources.calendar import calendar_for


def customer_quarterly(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    q_end = ts.period_end(F.to_date("o_orderdate"), "quarter")
    return (o.groupBy(F.col("o_custkey").alias("geo_id"), q_end.alias("quarter_end"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value")))


_D_CQ = """
cq AS (SELECT o_custkey AS geo_id,
              last_day(make_date(CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER), CAST(quarter(CAST(o_orderdate AS DATE)) * 3 AS INTEGER), 1)) AS quarter_end,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
       FROM orders GROUP BY 1, 2)
"""


# DuckDB's round() keeps the sign of a zero result (-0.0), Spark's does not; "+ 0.0" in the
# oracle SQL writes both zeros as 0.0 so the value hashes agree.
@plan("yoy_date_aware", "J3 J9 M3 T7", oracle=f"""
WITH {_D_CQ},
cur AS (SELECT geo_id, quarter_end, value, year(quarter_end) AS y, quarter(quarter_end) AS q FROM cq)
SELECT c.geo_id, CAST(year(c.quarter_end) * 10000 + month(c.quarter_end) * 100 + day(c.quarter_end) AS INTEGER) AS date_key,
       CAST(c.y AS INTEGER) AS year, CAST(c.q AS INTEGER) AS quarter, c.value,
       round(CASE WHEN p.value IS NOT NULL AND p.value <> 0 THEN (c.value - p.value) / p.value * 100 END, 2) + 0.0 AS pct_change_yoy
FROM cur c LEFT JOIN cur p ON p.geo_id = c.geo_id AND p.y = c.y - 1 AND p.q = c.q
""")
def yoy_date_aware(spark, sf_dir):
    """Quarterly YoY % vs the same quarter a year earlier; NULL across gaps or a zero base.
    Year/quarter labels come from the calendar dimension (broadcast: its size is the
    number of days on the calendar)."""
    cq = customer_quarterly(spark, sf_dir).withColumn("date_key", date_key("quarter_end"))
    cal = calendar_for(read(spark, sf_dir, "orders"), "o_orderdate").select("date_key", "year", "quarter")
    j = cq.join(broadcast_if_small(cal), "date_key")
    out = ts.period_change(j, "geo_id", "quarter_end", "value", grain="quarter", lag=4)
    return out.select("geo_id", "date_key", "year", "quarter", "value", "pct_change_yoy")


_D_NM = """
nm AS (SELECT c_nationkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS n_orders
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
nmo AS (SELECT *, year(month_end) * 12 + month(month_end) AS ord FROM nm)
"""


@plan("mom_change", "N9", oracle=f"""
WITH {_D_NM}
SELECT c.geo_id, c.month_end, c.value,
       round(CASE WHEN p.value IS NOT NULL AND p.value <> 0 THEN c.value / p.value - 1 END, 6) + 0.0 AS mom,
       round(CASE WHEN y.value IS NOT NULL AND y.value <> 0 THEN c.value / y.value - 1 END, 6) + 0.0 AS yoy
FROM nmo c LEFT JOIN nmo p ON p.geo_id = c.geo_id AND p.ord = c.ord - 1
LEFT JOIN nmo y ON y.geo_id = c.geo_id AND y.ord = c.ord - 12
""")
def mom_change(spark, sf_dir):
    """Month-over-month and year-over-year change as decimal fractions, calendar-exact."""
    nm = nation_monthly(spark, sf_dir).withColumn("_ord", month_ordinal("month_end"))
    cur = F.col("value")
    p1 = ts.prior_value("geo_id", "_ord", "value", 1)
    p12 = ts.prior_value("geo_id", "_ord", "value", 12)
    return nm.select("geo_id", "month_end", "value",
                     ts.pct_change(cur, p1, scale=1.0, digits=None).alias("_m"),
                     ts.pct_change(cur, p12, scale=1.0, digits=None).alias("_y")) \
             .select("geo_id", "month_end", "value",
                     F.round(F.col("_m"), 6).alias("mom"), F.round(F.col("_y"), 6).alias("yoy"))


@plan("rolling_3_12", "N8", oracle=f"""
WITH {_D_NM}
SELECT geo_id, month_end, value,
       round(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY geo_id ORDER BY ord RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)
             / count(*) OVER (PARTITION BY geo_id ORDER BY ord RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS avg_3m,
       round(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY geo_id ORDER BY ord RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
             / count(*) OVER (PARTITION BY geo_id ORDER BY ord RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS avg_12m,
       round(sum(value) OVER (PARTITION BY geo_id, year(month_end) ORDER BY month(month_end)
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS ytd
FROM nmo
""")
def rolling_3_12(spark, sf_dir):
    """Trailing 3- and 12-month means on the month ordinal (gap-safe) and year-to-date sum."""
    # money stays DECIMAL inside the window so the means are exact (HALF_UP at 6 places)
    nm = nation_monthly(spark, sf_dir).select("geo_id", "month_end", "value",
                                              F.col("value").cast("decimal(18,2)").alias("v"))
    out = ts.rolling_mean(nm, "geo_id", "month_end", "v", 3, out="avg_3m", digits=6)
    out = ts.rolling_mean(out, "geo_id", "month_end", "v", 12, out="avg_12m", digits=6)
    out = ts.year_to_date(out, "geo_id", "month_end", "v", out="ytd", digits=2)
    return out.select("geo_id", "month_end", "value", *[F.col(c).cast("double").alias(c)
                                                         for c in ("avg_3m", "avg_12m", "ytd")])


@plan("rank_in_month", "N10", oracle=f"""
WITH {_D_NM}
SELECT geo_id, month_end, value,
       CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER) AS dense_rank, round(percent_rank() OVER w, 6) AS pct_rank
FROM nm WINDOW w AS (PARTITION BY month_end ORDER BY value DESC NULLS LAST)
""")
def rank_in_month(spark, sf_dir):
    """Cross-entity rank and percentile of nations within each month."""
    nm = nation_monthly(spark, sf_dir).select("geo_id", "month_end", "value")
    return ts.rank_in_period(nm, "month_end", "value")


@plan("rank_customers", "N10", oracle="""
SELECT o_custkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value,
       CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER) AS dense_rank, round(percent_rank() OVER w, 6) AS pct_rank
FROM orders GROUP BY 1, 2 WINDOW w AS (PARTITION BY last_day(CAST(o_orderdate AS DATE)) ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC)
""")
def rank_customers(spark, sf_dir):
    """Customers, whose number grows with the data, ranked by order value within each month."""
    cp = customer_period(spark, sf_dir, "month")
    return ts.rank_in_period(cp.select(F.col("c_custkey").alias("geo_id"), F.last_day("p_start").alias("month_end"),
                                       F.col("v").cast("double").alias("value")), "month_end", "value")


@plan("gap_quarterly", "A8 Q7", oracle=f"""
WITH {_D_CQ}
SELECT geo_id, count(*) AS present,
       max(year(quarter_end) * 4 + quarter(quarter_end)) - min(year(quarter_end) * 4 + quarter(quarter_end)) + 1 AS span,
       max(year(quarter_end) * 4 + quarter(quarter_end)) - min(year(quarter_end) * 4 + quarter(quarter_end)) + 1 - count(*) AS missing
FROM cq GROUP BY geo_id
HAVING count(*) <> max(year(quarter_end) * 4 + quarter(quarter_end)) - min(year(quarter_end) * 4 + quarter(quarter_end)) + 1
""")
def gap_quarterly(spark, sf_dir):
    """Entities whose quarters are not contiguous: count ≠ max(ord) − min(ord) + 1."""
    cq = customer_quarterly(spark, sf_dir)
    g = ts.ordinal_gaps(cq, "geo_id", quarter_ordinal("quarter_end"))
    return g.where(F.col("missing") != 0).select(
        "geo_id", F.col("present"), F.col("span").cast("long").alias("span"), F.col("missing").cast("long").alias("missing"))


_D_SPACING = """
dates AS (SELECT o_custkey AS series_id, list_sort(list(DISTINCT CAST(o_orderdate AS DATE))) AS ds FROM orders GROUP BY o_custkey),
steps AS (SELECT series_id, len(ds) AS n,
                 list_transform(range(1, len(ds)), lambda i: date_diff('day', ds[i], ds[i + 1])) AS days FROM dates),
usual AS (SELECT series_id, n, days,
                 list_sort(list_transform(list_distinct(days),
                   lambda x: {'rarer': -len(list_filter(days, lambda y: y = x)), 'day': x}))[1].day AS modal FROM steps),
spacing AS (SELECT series_id, n, modal,
                   coalesce(list_sum(list_transform(list_filter(days, lambda x: x * 2 > modal * 3),
                     lambda x: CAST(round(x / modal) AS BIGINT) - 1)), 0) AS missing FROM usual)
"""


@plan("gap_native", "N4 N5 A10 A11", oracle=f"""
WITH {_D_SPACING}
SELECT series_id, n, CAST(modal AS INTEGER) AS modal_days, CAST(missing AS BIGINT) AS missing FROM spacing
""")
def gap_native(spark, sf_dir):
    """Per series: modal day spacing (ties → smaller gap) and estimated missing observations
    where a spacing exceeds 1.5 × modal (all order days of a customer as its series)."""
    o = read(spark, sf_dir, "orders")
    s = o.select(F.col("o_custkey").alias("series_id"), F.to_date("o_orderdate").alias("obs_date"))
    return ts.native_gaps(s, "series_id", "obs_date")


@plan("gap_report", "A9 A8 A10 A11 O4 O1", oracle=f"""
WITH {_D_CQ}, {_D_SPACING},
per AS (
  SELECT 'customer_monthly' AS fact, 'monthly' AS grain, count(DISTINCT date_trunc('month', o_orderdate)) AS present,
         date_diff('month', min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate))) + 1
           - count(DISTINCT date_trunc('month', o_orderdate)) AS missing FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT 'customer_quarterly', 'quarterly', count(*),
         date_diff('quarter', min(quarter_end), max(quarter_end)) + 1 - count(*) FROM cq GROUP BY geo_id
  UNION ALL
  SELECT 'customer_native', 'per-series native', n, missing FROM spacing)
SELECT fact, grain, count(*) AS entities, CAST(sum(present) AS BIGINT) AS "rows", count(*) FILTER (missing > 0) AS entities_with_gaps,
       CAST(sum(missing) AS BIGINT) AS missing_periods, if(sum(missing) = 0, 'OK', 'GAPS') AS verdict
FROM per GROUP BY fact, grain
""")
def gap_report(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    cm = o.select(F.col("o_custkey").alias("geo_id"), month_ordinal(F.to_date("o_orderdate")).alias("ord")).distinct()
    monthly = ts.gap_summary(ts.ordinal_gaps(cm, "geo_id", "ord"), label="customer_monthly", grain="monthly")
    cq = customer_quarterly(spark, sf_dir)
    quarterly = ts.gap_summary(ts.ordinal_gaps(cq, "geo_id", quarter_ordinal("quarter_end")),
                               label="customer_quarterly", grain="quarterly")
    nat = gap_native(spark, sf_dir).select(F.col("n").alias("present"), "missing")
    native = ts.gap_summary(nat, label="customer_native", grain="per-series native")
    return monthly.unionByName(quarterly).unionByName(native)


@plan("latest_per_key", "N1 O2", oracle="""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""")
def latest_per_key(spark, sf_dir):
    """Latest order per customer (ties → larger order key), as an aggregation."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
                                             "o_totalprice")
    return ts.latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@plan("latest_vintage", "N7 T5", oracle="""
SELECT l_orderkey, l_linenumber, realtime_start, value, vintages FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS realtime_start, l_extendedprice AS value,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS vintages,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def latest_vintage(spark, sf_dir):
    """Repeated (order, line) rows are vintages of one observation: keep the newest
    ``realtime_start`` (ship date), then the larger value; report how many vintages exist."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("realtime_start"),
        F.col("l_extendedprice").alias("value"))
    counts = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("vintages"),
                                                          F.max(F.struct("realtime_start", "value")).alias("m"))
    return counts.select("l_orderkey", "l_linenumber", "m.realtime_start", "m.value", "vintages")
