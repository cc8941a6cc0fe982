"""Derived-metric plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from medalloy.operators import metrics as mx
from medalloy.operators import timeseries as ts
from medalloy.operators.sizing import broadcast_if_small
from medalloy.plans.registry import plan
from medalloy.plans.tables import nation_monthly, read

# "value" feed = order value per nation-month, "rent" feed = lineitem value per nation-month
# (the two wide-panel feeds); the national series = total order value per month.


def _feeds(spark, sf_dir):
    nm = nation_monthly(spark, sf_dir).select("geo_id", "month_end", "value")
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # an order's lines are few, so grouping them first saves nothing: one join by order, then straight to nation x month
    geo = o.join(c, "o_custkey").select("l_orderkey", F.col("c_nationkey").alias("geo_id"))
    lines = li.select("l_orderkey", F.last_day(F.to_date("l_shipdate")).alias("month_end"), F.col("l_extendedprice").cast("decimal(18,2)").alias("s"))
    rent = lines.join(geo, "l_orderkey").groupBy("geo_id", "month_end").agg((F.sum("s").cast("double") / 100).alias("rent"))
    return nm.join(rent, ["geo_id", "month_end"], "full_outer")


_D_FEEDS = """
nm AS (SELECT c_nationkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
rent AS (SELECT c_nationkey AS geo_id, last_day(CAST(l_shipdate AS DATE)) AS month_end,
                CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 100 AS rent
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
f AS (SELECT * FROM nm FULL JOIN rent USING (geo_id, month_end))
"""


@plan("price_to_rent", "P9 M1 M2", oracle=f"""
WITH {_D_FEEDS}
SELECT geo_id, month_end, value, rent,
       round(CASE WHEN rent * 12 IS NOT NULL AND rent * 12 <> 0 THEN value / (rent * 12) END, 2) AS price_to_rent,
       round(CASE WHEN value IS NOT NULL AND value <> 0 THEN rent * 12 / value * 100 END, 2) AS gross_yield_pct
FROM f
""")
def price_to_rent(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return f.select("geo_id", "month_end", "value", "rent",
                    mx.price_to_rent("value", "rent").alias("price_to_rent"),
                    mx.gross_yield_pct("value", "rent").alias("gross_yield_pct"))


@plan("real_value", "M5 J12 M6", oracle=f"""
WITH {_D_FEEDS},
nat AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end, count(*) AS idx FROM orders GROUP BY 1),
base AS (SELECT idx AS base_idx FROM nat WHERE month_end = (SELECT min(month_end) FROM nat))
SELECT nm.geo_id, nm.month_end, nm.value, nat.idx AS national_index,
       CASE WHEN nat.idx IS NOT NULL AND nat.idx <> 0 THEN nm.value * base.base_idx / nat.idx END AS real_value,
       nm.value * nat.idx AS affordability_proxy
FROM nm LEFT JOIN nat ON nm.month_end = nat.month_end, base
""")
def real_value(spark, sf_dir):
    """Deflate metro values by a national monthly index (order count), based at the first
    month: sparse national add-on joined on date (NULL where absent)."""
    nm = nation_monthly(spark, sf_dir).select("geo_id", "month_end", "value")
    o = read(spark, sf_dir, "orders")
    nat = o.groupBy(F.last_day(F.to_date("o_orderdate")).alias("month_end")).agg(F.count(F.lit(1)).alias("national_index"))
    base = nat.agg(F.min_by("national_index", "month_end")).scalar()
    j = nm.join(broadcast_if_small(nat), "month_end", "left")
    return j.select("geo_id", "month_end", "value", "national_index",
                    mx.real_value(F.col("value"), F.col("national_index"), base, digits=None).alias("real_value"),
                    mx.affordability(F.col("value"), F.col("national_index")).alias("affordability_proxy"))


@plan("rebase", "M7", oracle="""
WITH nm AS (SELECT c_nationkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
ref AS (SELECT geo_id, arg_max(value, month_end) AS r FROM nm WHERE year(month_end) = 1996 GROUP BY 1)
SELECT nm.geo_id, nm.month_end, nm.value,
       round(CASE WHEN ref.r IS NOT NULL AND ref.r <> 0 THEN nm.value / ref.r * 100 END, 2) AS rebased
FROM nm LEFT JOIN ref ON nm.geo_id = ref.geo_id
""")
def rebase(spark, sf_dir):
    """Index every nation's series to 100 at its last month of 1996."""
    nm = nation_monthly(spark, sf_dir).select("geo_id", "month_end", "value")
    return mx.rebase(nm, ["geo_id"], "month_end", "value", ref_filter=F.year("month_end") == 1996)


@plan("conf_band", "M8", oracle="""
SELECT l_orderkey, l_linenumber, round(l_extendedprice - 1.96 * (l_tax * 1000), 2) + 0.0 AS lower_bound,
       round(l_extendedprice + 1.96 * (l_tax * 1000), 2) AS upper_bound FROM lineitem
""")
def conf_band(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    lo, hi = mx.confidence_band(F.col("l_extendedprice"), F.col("l_tax") * 1000)
    return li.select("l_orderkey", "l_linenumber", lo.alias("lower_bound"), hi.alias("upper_bound"))


@plan("risk_band", "M9 T12", oracle="""
WITH s AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal / 100 END AS score FROM customer)
SELECT c_custkey,
       CASE WHEN score IS NULL THEN 'No Rating' WHEN score < 20 THEN 'Very Low' WHEN score < 40 THEN 'Relatively Low'
            WHEN score < 60 THEN 'Relatively Moderate' WHEN score < 80 THEN 'Relatively High'
            WHEN score <= 100 THEN 'Very High' END AS risk_label,
       CASE WHEN score IS NULL THEN 0 WHEN score < 20 THEN 1 WHEN score < 40 THEN 2 WHEN score < 60 THEN 3
            WHEN score < 80 THEN 4 WHEN score <= 100 THEN 5 END AS risk_key,
       CASE WHEN score IS NULL THEN 'No Rating' WHEN 100 - score < 20 THEN 'Very Low' WHEN 100 - score < 40 THEN 'Relatively Low'
            WHEN 100 - score < 60 THEN 'Relatively Moderate' WHEN 100 - score < 80 THEN 'Relatively High'
            WHEN 100 - score <= 100 THEN 'Very High' END AS resilience_label
FROM s
""")
def risk_band(spark, sf_dir):
    """Fixed quintile bands of a 0–100 score (balance/100; negative = not rated), plus the
    flipped scale for a higher-is-better score."""
    c = read(spark, sf_dir, "customer")
    score = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 100)
    label, key = mx.risk_band(score)
    rlabel, _ = mx.risk_band(score, higher_is_better=True)
    return c.select("c_custkey", label.alias("risk_label"), key.alias("risk_key"), rlabel.alias("resilience_label"))


@plan("spread", "M10 J12", oracle="""
WITH nm AS (SELECT c_nationkey AS geo_id, year(CAST(o_orderdate AS DATE)) * 12 + month(CAST(o_orderdate AS DATE)) AS ord,
                   last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
nat AS (SELECT year(CAST(o_orderdate AS DATE)) * 12 + month(CAST(o_orderdate AS DATE)) AS ord,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1),
g AS (SELECT c.geo_id, c.month_end, c.ord,
             CASE WHEN p.value IS NOT NULL AND p.value <> 0 THEN (c.value - p.value) / p.value * 100 END AS growth
      FROM nm c LEFT JOIN nm p ON p.geo_id = c.geo_id AND p.ord = c.ord - 12),
ng AS (SELECT c.ord, CASE WHEN p.value IS NOT NULL AND p.value <> 0 THEN (c.value - p.value) / p.value * 100 END AS ngrowth
       FROM nat c LEFT JOIN nat p ON p.ord = c.ord - 12)
SELECT g.geo_id, g.month_end, round(g.growth, 2) AS growth_pct, round(ng.ngrowth, 2) AS national_growth_pct,
       round(g.growth - ng.ngrowth, 2) + 0.0 AS spread_pct, round((g.growth - ng.ngrowth) * 100, 2) + 0.0 AS spread_bps
FROM g LEFT JOIN ng ON g.ord = ng.ord
""")
def spread(spark, sf_dir):
    """Metro YoY growth minus national YoY growth on the same month (and in basis points)."""
    nm = nation_monthly(spark, sf_dir).select("geo_id", "month_end", "value")
    g = ts.period_change(nm, "geo_id", "month_end", "value", grain="month", lag=12, out="growth", digits=None)
    o = read(spark, sf_dir, "orders")
    nat = (o.groupBy(F.last_day(F.to_date("o_orderdate")).alias("month_end"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
            .withColumn("_k", F.lit(1)))
    ng = ts.period_change(nat, "_k", "month_end", "value", grain="month", lag=12, out="ngrowth", digits=None)
    j = g.join(broadcast_if_small(ng.select("month_end", "ngrowth")), "month_end", "left")
    return j.select("geo_id", "month_end", F.round("growth", 2).alias("growth_pct"),
                    F.round("ngrowth", 2).alias("national_growth_pct"),
                    mx.spread(F.col("growth"), F.col("ngrowth")).alias("spread_pct"),
                    mx.bps_change(F.col("growth"), F.col("ngrowth")).alias("spread_bps"))


@plan("heat_band", "M11 P9", oracle="""
SELECT o_custkey, count(*) AS active, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS pending,
       round(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) / count(*), 4) AS pending_ratio,
       CASE WHEN sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) / count(*) > 0.6 THEN 'hot'
            WHEN sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) / count(*) < 0.2 THEN 'cold' ELSE 'neutral' END AS heat
FROM orders GROUP BY 1
""")
def heat_band(spark, sf_dir):
    """Listing-flow ratio (pending / active orders per customer) and its heat band."""
    o = read(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("active"),
                                   F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("pending"))
    ratio = mx.safe_ratio(F.col("pending"), F.col("active"), digits=None)
    return g.select("o_custkey", "active", "pending", F.round(ratio, 4).alias("pending_ratio"),
                    mx.heat_band(ratio).alias("heat"))


@plan("rate_change_bps", "M12 J9", oracle="""
WITH r AS (SELECT o_orderpriority AS series_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
                  year(CAST(o_orderdate AS DATE)) * 12 + month(CAST(o_orderdate AS DATE)) AS ord,
                  sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) * 100 AS rate FROM orders GROUP BY 1, 2, 3)
SELECT c.series_id, c.month_end, c.rate, round((c.rate - p.rate) * 100, 2) + 0.0 AS change_bps
FROM r c LEFT JOIN r p ON p.series_id = c.series_id AND p.ord = c.ord - 12
""")
def rate_change_bps(spark, sf_dir):
    """Share of filled orders per series and month (a rate in percent) against the same month a year before."""
    o = read(spark, sf_dir, "orders")
    rate = F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)) / F.count(F.lit(1)) * 100
    r = (o.groupBy(F.col("o_orderpriority").alias("series_id"), F.last_day(F.to_date("o_orderdate")).alias("month_end"))
         .agg(rate.alias("rate")).withColumn("_m", F.year("month_end") * 12 + F.month("month_end")))
    year = Window.partitionBy("series_id").orderBy("_m").rangeBetween(-12, -12)
    return r.select("series_id", "month_end", "rate", (mx.bps_change(F.col("rate"), F.max("rate").over(year)) + 0.0).alias("change_bps"))


@plan("rent_burden", "M13 P9", oracle="""
WITH i AS (SELECT c_nationkey AS geo_id, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS income FROM customer GROUP BY 1),
r AS (SELECT c_nationkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS rent
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT geo_id, month_end, rent, income,
       round(CASE WHEN income IS NOT NULL AND income <> 0 THEN rent * 12 / income * 100 END, 2) AS rent_burden_pct
FROM r LEFT JOIN i USING (geo_id)
""")
def rent_burden(spark, sf_dir):
    """Monthly nation value as rent against the nation's summed balances as income."""
    income = (read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("geo_id"))
              .agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("income")))
    r = nation_monthly(spark, sf_dir).select("geo_id", "month_end", F.col("value").alias("rent"))
    j = r.join(broadcast_if_small(income), "geo_id", "left")
    return j.select("geo_id", "month_end", "rent", "income", mx.rent_burden("rent", "income").alias("rent_burden_pct"))


@plan("flow_ratio", "M11 P9", oracle="""
SELECT o_custkey, n_new, active, round(CASE WHEN active <> 0 THEN n_new / active END, 4) AS new_active_ratio
FROM (SELECT o_custkey, CAST(sum(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS n_new,
             CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS BIGINT) AS active FROM orders GROUP BY 1)
""")
def flow_ratio(spark, sf_dir):
    """New against active listings per customer: orders from 1998 on against orders not yet filled; NULL without active ones."""
    g = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"), 1).otherwise(0)).alias("n_new"),
        F.sum(F.when(F.col("o_orderstatus") != "F", 1).otherwise(0)).alias("active"))
    return g.select("o_custkey", "n_new", "active", mx.safe_ratio("n_new", "active", digits=4).alias("new_active_ratio"))


@plan("natural_bands", "M9", oracle="""
WITH RECURSIVE h AS (SELECT round(c_acctbal / 100 * 10)::bigint AS x, count(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1),
p AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY x) AS i, x, sum(n) OVER (ORDER BY x) AS w, sum(n * x) OVER (ORDER BY x) AS wx, sum(n * x * x) OVER (ORDER BY x) AS wxx FROM h
  UNION ALL SELECT 0, NULL, 0, 0, 0),
c AS MATERIALIZED (SELECT a.i AS a, b.i AS b, ((b.wxx - a.wxx) * (b.w - a.w) - (b.wx - a.wx) * (b.wx - a.wx))::double / (b.w - a.w)::double AS cost
                   FROM p a JOIN p b ON a.i < b.i),
d AS (SELECT 1 AS layer, b, cost, a FROM c WHERE a = 0
      UNION ALL
      (SELECT layer + 1, c.b, min(d.cost + c.cost), arg_min(c.a, (d.cost + c.cost, c.a)) FROM d JOIN c ON c.a = d.b WHERE d.layer < 5 GROUP BY d.layer, c.b)),
path AS (SELECT 5 AS band, a, b FROM d WHERE layer = 5 AND b = (SELECT max(i) FROM p)
         UNION ALL
         (SELECT path.band - 1, d.a, d.b FROM path JOIN d ON d.layer = path.band - 1 AND d.b = path.a WHERE path.band > 1))
SELECT band, lo.x / 10 AS low, hi.x / 10 AS high, (hi.w - coalesce(before.w, 0))::bigint AS n
FROM path JOIN p lo ON lo.i = path.a + 1 JOIN p hi ON hi.i = path.b JOIN p before ON before.i = path.a
""")
def natural_bands(spark, sf_dir):
    """Five bands of the 0-100 score (balance/100, one digit) of least squared distance."""
    score = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 100)
    return mx.natural_breaks(read(spark, sf_dir, "customer").select(score.alias("score")), "score", 5, digits=1)
