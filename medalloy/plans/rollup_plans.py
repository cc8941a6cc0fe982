"""Rollup, enrichment-join and check plans.

Analogue: customers are the fine-grained units ("counties"), nations the metros, regions
the coarse level; a customer's order count is its weight ("population"), its order value
the extensive measure, its account balance (negative = not reported) the intensive score.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.operators import checks as ck
from medalloy.operators import rollup as ru
from medalloy.operators.sizing import broadcast_if_small
from medalloy.plans.registry import plan
from medalloy.plans.tables import customer_period, read


def units(spark, sf_dir):
    """Customer units with weight (order count), extensive value and an intensive score."""
    o = read(spark, sf_dir, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("population"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"))
    c = read(spark, sf_dir, "customer")
    return c.join(per, "c_custkey", "left").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        F.coalesce("population", F.lit(0)).cast("long").alias("population"), "value",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("score"))


_D_UNITS = """
units AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, coalesce(p.population, 0) AS population, p.value,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS score
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS population, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value
                             FROM orders GROUP BY 1) p ON p.o_custkey = c.c_custkey)
"""


@plan("bridge_rollup", "J1 A2 A3 A4 A5 T10", oracle=f"""
WITH {_D_UNITS},
bridge AS (SELECT n_nationkey AS c_nationkey, n_regionkey AS region_key FROM nation WHERE n_regionkey <> 4)
SELECT b.region_key, CAST(sum(u.population) AS BIGINT) AS population,
       CAST(round(sum(u.value)) AS BIGINT) AS value,
       round(sum(u.score * u.population) / nullif(sum(CASE WHEN u.score IS NOT NULL THEN u.population END), 0), 2) AS score_wmean,
       round(avg(u.score), 2) AS score_mean,
       min(u.c_name) AS representative, count(*) AS units
FROM units u JOIN bridge b ON u.c_nationkey = b.c_nationkey GROUP BY 1
""")
def bridge_rollup(spark, sf_dir):
    """Units → bridge (nations of regions 0–3; region 4 is uncovered and drops) → region:
    extensive sums, per-measure weighted mean, plain mean and a string-min representative."""
    u = units(spark, sf_dir)
    bridge = read(spark, sf_dir, "nation").where("n_regionkey <> 4").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region_key"))
    out = ru.bridge_rollup(u, bridge, on="c_nationkey", by="region_key",
                           sums={"population": "population"}, round_sums={"value": "value"},
                           weighted={"score_wmean": "score"}, weight="population",
                           means={"score_mean": "score"}, mins={"representative": "c_name"},
                           counts={"units": None}, digits=2)
    return out.withColumn("population", F.col("population").cast("long"))


@plan("per_capita", "A14 T11", oracle=f"""
WITH {_D_UNITS}
SELECT c_mktsegment, CAST(sum(population) AS BIGINT) AS population, CAST(sum(value) AS DOUBLE) AS value,
       round(CAST(sum(value) AS DOUBLE) / CAST(sum(population) AS DOUBLE), 2) AS value_per_capita
FROM units GROUP BY 1
""")
def per_capita(spark, sf_dir):
    """Ratio of sums at a coarser grain (segment): Σvalue / Σpopulation."""
    u = units(spark, sf_dir)
    g = u.groupBy("c_mktsegment").agg(F.sum("population").cast("long").alias("population"),
                                      F.sum("value").cast("double").alias("value"))
    return g.withColumn("value_per_capita",
                        F.round(F.try_divide(F.col("value"), F.col("population").cast("double")), 2))


@plan("enrich_chain", "J5 P10 S8 Q8", oracle="""
WITH rep AS (SELECT o_custkey, min(CAST(o_orderkey AS VARCHAR)) AS first_order_id FROM orders GROUP BY 1)
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, rep.first_order_id,
       CASE r.r_name WHEN 'AFRICA' THEN 'South' WHEN 'AMERICA' THEN 'West' WHEN 'ASIA' THEN 'Northeast'
                     WHEN 'EUROPE' THEN 'Midwest' END AS census_region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN rep ON rep.o_custkey = c.c_custkey
""")
def enrich_chain(spark, sf_dir):
    """Chained left joins: master + name + parent level + representative id + static
    lookup (inline map; an unmapped key stays NULL). A5 string min gives the representative."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rep = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(F.col("o_orderkey").cast("string")).alias("first_order_id"))
    # Static lookup of region name → census-style region label (MIDDLE EAST unmapped).
    lookup = spark.createDataFrame(
        [("AFRICA", "South"), ("AMERICA", "West"), ("ASIA", "Northeast"), ("EUROPE", "Midwest")],
        "r_name string, census_region string")
    j = (c.join(broadcast_if_small(n), c.c_nationkey == n.n_nationkey, "left")
          .join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey, "left")
          .join(rep, "c_custkey", "left")
          .join(broadcast_if_small(lookup), "r_name", "left"))
    return j.select("c_custkey", "c_name", "n_name", "r_name", "first_order_id", "census_region")


@plan("coverage", "Q8", oracle="""
WITH rep AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'),
l AS (SELECT d.doc_id, lb.quality, lb.toxic, rep.o_custkey FROM documents d
      LEFT JOIN labels lb ON d.doc_id = lb.doc_id LEFT JOIN rep ON rep.o_custkey = d.doc_id)
SELECT count(*) AS "rows", count(quality) AS quality_present, count(toxic) AS toxic_present,
       count(o_custkey) AS o_custkey_present FROM l
""")
def coverage(spark, sf_dir):
    """Non-null counts of enrichment columns after left joins (documents + labels + a
    second, partial enrichment)."""
    d = read(spark, sf_dir, "documents").select("doc_id")
    lb = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rep = (read(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
           .select(F.col("o_custkey").alias("doc_id")).distinct().withColumn("o_custkey", F.col("doc_id")))
    j = d.join(lb, "doc_id", "left").join(rep, "doc_id", "left")
    return ck.coverage(j, ["quality", "toxic", "o_custkey"])


@plan("outer_feeds", "J6 T19", oracle="""
WITH f1 AS (SELECT o_custkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_value FROM orders GROUP BY 1, 2),
f2 AS (SELECT o.o_custkey AS geo_id, last_day(CAST(l.l_shipdate AS DATE)) AS month_end,
              CAST(sum(l.l_quantity) AS DOUBLE) AS shipped_qty
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
f3 AS (SELECT o_custkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end, count(*) AS open_orders
       FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2)
SELECT geo_id, month_end, order_value, shipped_qty, open_orders
FROM f1 FULL JOIN f2 USING (geo_id, month_end) FULL JOIN f3 USING (geo_id, month_end)
""")
def outer_feeds(spark, sf_dir):
    """Three monthly feeds on (geo, month): tag + union + one grouped pivot — one shuffle
    instead of two full outer joins, same result as FULL JOIN ... USING."""
    o = read(spark, sf_dir, "orders")
    li = read(spark, sf_dir, "lineitem")
    f1 = (o.groupBy(F.col("o_custkey").alias("geo_id"), F.last_day(F.to_date("o_orderdate")).alias("month_end"))
           .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("order_value")))
    # an order's lines are few: joined as they are, one shuffle by order, then added up per (customer, ship month)
    lines = li.select("l_orderkey", F.last_day(F.to_date("l_shipdate")).alias("month_end"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    f2 = (lines.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
               .groupBy(F.col("o_custkey").alias("geo_id"), "month_end")
               .agg(F.sum("q").cast("double").alias("shipped_qty")))
    f3 = (o.where(F.col("o_orderstatus") == "O")
           .groupBy(F.col("o_custkey").alias("geo_id"), F.last_day(F.to_date("o_orderdate")).alias("month_end"))
           .agg(F.count(F.lit(1)).alias("open_orders")))
    from medalloy.operators.joins import outer_merge_feeds
    return outer_merge_feeds([f1, f2, f3], ["geo_id", "month_end"])


@plan("outer_profile", "J7 P1", oracle="""
WITH hz AS (SELECT doc_id, quality, toxic FROM labels),
cl AS (SELECT doc_id, n_chars, lang FROM documents)
SELECT coalesce(hz.doc_id, cl.doc_id) AS doc_id, hz.quality AS quality_flag, hz.toxic AS toxic_flag,
       cl.n_chars AS text_length, cl.lang AS language
FROM hz FULL OUTER JOIN cl ON hz.doc_id = cl.doc_id
""")
def outer_profile(spark, sf_dir):
    """Two entity profiles (labels, document stats) full-outer joined on a
    coalesced key, with an ordered rename map."""
    hz = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    cl = read(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    from medalloy.operators.joins import full_outer_coalesce, rename
    j = full_outer_coalesce(hz, cl, "doc_id")
    return rename(j, [("doc_id", "doc_id"), ("quality", "quality_flag"), ("toxic", "toxic_flag"),
                      ("n_chars", "text_length"), ("lang", "language")])


@plan("fk_orphans", "J8 Q5 W14", oracle="""
SELECT 'labels.doc_id' AS fk, count(*) AS orphans FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL
SELECT 'customer.nation', count(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 4)
UNION ALL
SELECT 'orders.customer', count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
""")
def fk_orphans(spark, sf_dir):
    """Orphan counts per declared foreign key (anti-joins), reported separately."""
    d = read(spark, sf_dir, "documents")
    lb = read(spark, sf_dir, "labels")
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation").where("n_regionkey <> 4").select(F.col("n_nationkey").alias("c_nationkey"))
    o = read(spark, sf_dir, "orders")
    parts = [
        ck.orphan_report(d, {"labels.doc_id": (lb, "doc_id")}),
        ck.orphan_report(c, {"customer.nation": (n, "c_nationkey")}),
        ck.orphan_report(o.withColumnRenamed("o_custkey", "c_custkey"), {"orders.customer": (c, "c_custkey")}),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@plan("row_counts", "A13 O4 O1 S14", oracle="""
SELECT 'dim' AS kind, 'region' AS table_name, count(*) AS row_count FROM region
UNION ALL SELECT 'dim', 'nation', count(*) FROM nation
UNION ALL SELECT 'dim', 'customer', count(*) FROM customer
UNION ALL SELECT 'dim', 'supplier', count(*) FROM supplier
UNION ALL SELECT 'dim', 'part', count(*) FROM part
UNION ALL SELECT 'fact', 'orders', count(*) FROM orders
UNION ALL SELECT 'fact', 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'fact', 'events', count(*) FROM events
UNION ALL SELECT 'text', 'documents', count(*) FROM documents
UNION ALL SELECT 'text', 'labels', count(*) FROM labels
""")
def row_counts(spark, sf_dir):
    kinds = {"region": "dim", "nation": "dim", "customer": "dim", "supplier": "dim", "part": "dim",
             "orders": "fact", "lineitem": "fact", "events": "fact", "documents": "text", "labels": "text"}
    return ck.row_counts({t: read(spark, sf_dir, t) for t in kinds}, kinds).orderBy("kind", "table_name")


@plan("reconcile", "Q6 Q9 W5", oracle="""
SELECT (SELECT count(*) FROM orders) AS input_rows,
       (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS silver,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS quarantine,
       (SELECT count(*) FROM orders WHERE o_orderstatus IS NULL) = 0 AS conserved
""")
def reconcile(spark, sf_dir):
    """Conservation: input rows = good branch + quarantine branch."""
    o = read(spark, sf_dir, "orders")
    return ck.conservation(o, {"silver": o.where(F.col("o_orderstatus") != "P"),
                               "quarantine": o.where(F.col("o_orderstatus") == "P")})


@plan("quarter_from_month", "A16", oracle="""
WITH m AS (SELECT o_custkey AS geo_id, last_day(CAST(o_orderdate AS DATE)) AS month_end,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)
SELECT geo_id, last_day(make_date(CAST(year(month_end) AS INTEGER), CAST(quarter(month_end) * 3 AS INTEGER), 1)) AS quarter_end,
       round(avg(value), 4) AS value_mean, arg_max(value, month_end) AS value_last, count(*) AS months
FROM m GROUP BY 1, 2
""")
def quarter_from_month(spark, sf_dir):
    """Monthly → quarterly: mean of the months present and the last month's value."""
    o = read(spark, sf_dir, "orders")
    m = (o.groupBy(F.col("o_custkey").alias("geo_id"), F.last_day(F.to_date("o_orderdate")).alias("month_end"))
          .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value")))
    q = F.last_day(F.add_months(F.trunc("month_end", "quarter"), 2))
    return m.groupBy("geo_id", q.alias("quarter_end")).agg(
        F.round(F.avg("value"), 4).alias("value_mean"), F.max_by("value", "month_end").alias("value_last"),
        F.count(F.lit(1)).alias("months"))


@plan("month_from_quarter", "M14", oracle="""
WITH q AS (SELECT c_nationkey AS geo_id, year(CAST(o_orderdate AS DATE)) AS y, quarter(CAST(o_orderdate AS DATE)) AS qq,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT geo_id, last_day(make_date(CAST(y AS INTEGER), CAST((qq - 1) * 3 + k AS INTEGER), 1)) AS month_end, value
FROM q, (VALUES (1), (2), (3)) t(k)
""")
def month_from_quarter(spark, sf_dir):
    """Quarterly → monthly fill: each quarter's value applies to its three months."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cq = customer_period(spark, sf_dir, "quarter")  # pre-aggregate before the dimension join
    q = (cq.join(c, "c_custkey")
           .groupBy(F.col("c_nationkey").alias("geo_id"), F.col("p_start").alias("q_start"))
           .agg(F.sum("v").cast("double").alias("value")))
    months = F.sequence(F.col("q_start"), F.add_months("q_start", 2), F.expr("INTERVAL 1 MONTH"))
    return (q.select("geo_id", F.explode(months).alias("m"), "value")
             .select("geo_id", F.last_day("m").alias("month_end"), "value"))
