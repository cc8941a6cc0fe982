"""Reshape plans: wide panels built from the tables (one column per period, as the
source files arrive), then detected and unpivoted back (R1–R7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from medalloy.operators import reshape as rs
from medalloy.operators import rollup as ru
from medalloy.operators import timeseries as ts
from medalloy.plans.registry import plan
from medalloy.plans.tables import SERIES, customer_period, read


def _month_labels(lo: dt.date, hi: dt.date) -> list[str]:
    out, y, m = [], lo.year, lo.month
    while (y, m) <= (hi.year, hi.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + (m == 12), m % 12 + 1)
    return out


def _wide(df, ids, label, labels, value):
    """Wide panel: one column per period label (explicit list, so no distinct job)."""
    return df.groupBy(*ids).pivot(label, labels).agg(F.sum(value).cast("double"))


def wide_monthly_panel(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    b = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")).first()
    labels = _month_labels(b["lo"], b["hi"])  # header metadata: the panel's schema depends on it
    staged = o.select(F.col("o_custkey").alias("region_id"),
                      F.date_format("o_orderdate", "yyyy-MM").alias("label"),
                      F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return _wide(staged, ["region_id"], "label", labels, "v"), labels


_D_MONTH_GRID = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
m AS (SELECT last_day(CAST(g AS DATE)) AS period_date FROM b,
      generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH) t(g)),
ids AS (SELECT DISTINCT o_custkey AS region_id FROM orders),
agg AS (SELECT o_custkey AS region_id, last_day(CAST(o_orderdate AS DATE)) AS period_date,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)
"""


@plan("unpivot_month", "R1 R2 R3 R4 T19", oracle=_D_MONTH_GRID + """
SELECT ids.region_id, m.period_date, agg.value
FROM ids CROSS JOIN m LEFT JOIN agg ON agg.region_id = ids.region_id AND agg.period_date = m.period_date
""")
def unpivot_month(spark, sf_dir):
    """Customer × month panel ('YYYY-MM' headers) back to long; empty cells stay as NULL rows."""
    wide, _ = wide_monthly_panel(spark, sf_dir)
    return rs.unpivot(wide)


@plan("read_and_unpivot", "S1 R1 R2 R3 R4 W9", oracle=_D_MONTH_GRID + """
SELECT CAST(ids.region_id AS VARCHAR) AS region_id, m.period_date, agg.value
FROM ids CROSS JOIN m LEFT JOIN agg ON agg.region_id = ids.region_id AND agg.period_date = m.period_date
""")
def read_and_unpivot(spark, sf_dir):
    """The panel written as a wide CSV (one column per month, empty cells for no orders),
    read back all-string, validated and unpivoted."""
    from medalloy.sources.files import staging_path
    wide, _ = wide_monthly_panel(spark, sf_dir)
    path = staging_path(spark, "wide_panel")
    wide.write.mode("overwrite").option("header", True).csv(path)
    return rs.read_and_unpivot(spark, path)


@plan("unpivot_conservation", "R5 Q6", oracle=_D_MONTH_GRID + """
SELECT (SELECT count(*) FROM ids) AS wide_rows,
       (SELECT count(*) FROM ids CROSS JOIN m) AS long_rows,
       (SELECT count(*) FROM ids) * (SELECT count(*) FROM m) AS expected_rows,
       (SELECT count(*) FROM ids CROSS JOIN m) = (SELECT count(*) FROM ids) * (SELECT count(*) FROM m) AS conserved
""")
def unpivot_conservation(spark, sf_dir):
    wide, labels = wide_monthly_panel(spark, sf_dir)
    return rs.conservation(wide, rs.unpivot(wide), len(labels))


def _quarter_label(d):
    return F.format_string("%04d-Q%d", F.year(d), F.quarter(d))


@plan("unpivot_quarter", "R1 R3 R4", oracle="""
WITH q AS (SELECT DISTINCT year(CAST(o_orderdate AS DATE)) AS y, quarter(CAST(o_orderdate AS DATE)) AS qq FROM orders),
n AS (SELECT DISTINCT c_nationkey AS nation_id FROM customer JOIN orders ON o_custkey = c_custkey),
agg AS (SELECT c_nationkey AS nation_id, year(CAST(o_orderdate AS DATE)) AS y, quarter(CAST(o_orderdate AS DATE)) AS qq,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT n.nation_id, last_day(make_date(CAST(q.y AS INTEGER), CAST(q.qq * 3 AS INTEGER), 1)) AS period_date, agg.value
FROM n CROSS JOIN q LEFT JOIN agg ON agg.nation_id = n.nation_id AND agg.y = q.y AND agg.qq = q.qq
""")
def unpivot_quarter(spark, sf_dir):
    """Nation × quarter panel ('YYYY-Qn' headers; quarters present in the data)."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    labels = sorted(r[0] for r in o.select(_quarter_label(F.to_date("o_orderdate"))).distinct().collect())
    cq = customer_period(spark, sf_dir, "quarter")  # pre-aggregate before the dimension join
    staged = cq.join(c, "c_custkey").select(F.col("c_nationkey").alias("nation_id"),
                                            _quarter_label(F.col("p_start")).alias("label"), "v")
    return rs.unpivot(_wide(staged, ["nation_id"], "label", labels, "v"))


def _iso_week_label(d):
    thursday = F.date_add(d, 3 - F.weekday(d))  # ISO year = year of the week's Thursday
    return F.format_string("%04d-W%02d", F.year(thursday), F.weekofyear(d))


@plan("unpivot_week", "R1 R3 R4", oracle="""
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS d, value FROM events),
w AS (SELECT DISTINCT CAST(d + (7 - isodow(d)) * INTERVAL 1 DAY AS DATE) AS period_date FROM e),
k AS (SELECT DISTINCT event_type FROM e),
agg AS (SELECT event_type, CAST(d + (7 - isodow(d)) * INTERVAL 1 DAY AS DATE) AS period_date,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM e GROUP BY 1, 2)
SELECT k.event_type, w.period_date, agg.value
FROM k CROSS JOIN w LEFT JOIN agg ON agg.event_type = k.event_type AND agg.period_date = w.period_date
""")
def unpivot_week(spark, sf_dir):
    """Event type × ISO week panel ('YYYY-Www' headers) → week-ending Sunday."""
    e = read(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("d"),
                                             F.col("value").cast("decimal(18,2)").alias("v"))
    labels = sorted(r[0] for r in e.select(_iso_week_label(F.col("d"))).distinct().collect())
    staged = e.select("event_type", _iso_week_label(F.col("d")).alias("label"), "v")
    return rs.unpivot(_wide(staged, ["event_type"], "label", labels, "v"))


@plan("unpivot_year", "R1 R3 R4", oracle="""
WITH y AS (SELECT DISTINCT year(CAST(o_orderdate AS DATE)) AS y FROM orders),
r AS (SELECT DISTINCT o_orderpriority AS series_id FROM orders),
agg AS (SELECT o_orderpriority AS series_id, year(CAST(o_orderdate AS DATE)) AS y,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)
SELECT r.series_id, make_date(CAST(y.y AS INTEGER), 12, 31) AS period_date, agg.value
FROM r CROSS JOIN y LEFT JOIN agg ON agg.series_id = r.series_id AND agg.y = y.y
""")
def unpivot_year(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    labels = sorted(str(r[0]) for r in o.select(F.year("o_orderdate")).distinct().collect())
    staged = o.select(F.col("o_orderpriority").alias("series_id"), F.year("o_orderdate").cast("string").alias("label"),
                      F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return rs.unpivot(_wide(staged, ["series_id"], "label", labels, "v"))


_PIVOT = ",\n       ".join(
    f"CAST(sum(CASE WHEN o_orderpriority = '{k}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {v}"
    for k, v in SERIES.items())


@plan("pivot_priority", "R6 A7", oracle=f"""
SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end,
       {_PIVOT}
FROM orders GROUP BY 1
""")
def pivot_priority(spark, sf_dir):
    """Long → wide: month × priority value sums, fixed value list."""
    o = read(spark, sf_dir, "orders").select(
        F.last_day(F.to_date("o_orderdate")).alias("month_end"), "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    agg = o.groupBy("month_end", "o_orderpriority").agg(F.sum("v").cast("double").alias("v"))
    return ts.pivot_wide(agg, "month_end", "o_orderpriority", "v", SERIES)


@plan("level_stack", "R7 A14 A15 A3", oracle="""
WITH oc AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey),
c AS (SELECT c.c_custkey, c.c_acctbal, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name,
             CAST(coalesce(oc.n_orders, 0) AS DOUBLE) AS w
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
      LEFT JOIN oc ON oc.o_custkey = c.c_custkey)
SELECT 'nation' AS geo_level, CAST(n_nationkey AS VARCHAR) AS geo_id, n_name AS geo_name, count(*) AS n_members,
       CAST(round(sum(CAST(c_acctbal AS DECIMAL(18,2))), 2) AS DOUBLE) AS acctbal,
       round(sum(c_acctbal * w) / sum(CASE WHEN c_acctbal IS NOT NULL THEN w END), 2) AS acctbal_wmean
FROM c GROUP BY n_nationkey, n_name
UNION ALL
SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name, count(*),
       CAST(round(sum(CAST(c_acctbal AS DECIMAL(18,2))), 2) AS DOUBLE),
       round(sum(c_acctbal * w) / sum(CASE WHEN c_acctbal IS NOT NULL THEN w END), 2)
FROM c GROUP BY r_regionkey, r_name
UNION ALL
SELECT 'all', NULL, NULL, count(*), CAST(round(sum(CAST(c_acctbal AS DECIMAL(18,2))), 2) AS DOUBLE),
       round(sum(c_acctbal * w) / sum(CASE WHEN c_acctbal IS NOT NULL THEN w END), 2) FROM c
""")
def level_stack(spark, sf_dir):
    """Customers rolled to nation, region and total in one GROUPING SETS pass.

    The weight is the customer's order count (the population analogue), pre-aggregated on
    the order side so the join to customers is one row per key on both sides.
    """
    c = read(spark, sf_dir, "customer")
    oc = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    j = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
          .join(oc, "c_custkey", "left")
          .select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("acct"), F.col("c_acctbal"),
                  "n_nationkey", "n_name", "r_regionkey", "r_name",
                  F.coalesce(F.col("n_orders"), F.lit(0)).cast("double").alias("w"),
                  F.lit("all").alias("all_id")))
    out = ru.level_stack(j, [("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"),
                             ("all", "all_id", None)],
                         sums={"acctbal": "acct"}, weighted={"acctbal_wmean": "c_acctbal"}, weight="w")
    return (out.withColumn("geo_id", F.when(F.col("geo_level") == "all", None).otherwise(F.col("geo_id")))
               .withColumn("acctbal", F.col("acctbal").cast("double")))
