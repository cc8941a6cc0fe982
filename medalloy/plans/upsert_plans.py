"""Upsert plans (W1–W7, W11, O6). Target/source batches are time slices of orders:
the "history" load holds orders before 1999, the new batch every order from 1998 on,
re-priced (+100) where the order is still open — so the batch overlaps, changes and adds rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.functions.hashing import row_hash
from medalloy.operators import upsert as up
from medalloy.plans.registry import plan
from medalloy.plans.tables import read
from medalloy.sources import files as fs
from medalloy.store import TableStore, cut_lineage

_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _batches(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("date")).select(*_COLS, "o_orderdate")
    source = (o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date"))
               .select(*_COLS, "o_orderdate")
               .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 100.0)
                                           .otherwise(F.col("o_totalprice"))))
    return target, source


_D_BATCHES = """
t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate
      FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1999-01-01'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 100.0 ELSE o_totalprice END AS o_totalprice,
             o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate
      FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01')
"""


@plan("upsert_all", "W1 W5", oracle=f"""
WITH {_D_BATCHES}
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'kept' ELSE 'update' END AS _change,
       CAST(CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS _src_rows
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_all(spark, sf_dir):
    target, source = _batches(spark, sf_dir)
    return up.merge_upsert(target, source, "o_orderkey")


_D_HASH = "md5(concat_ws('|', {cols}))"


def _d_hash(alias):
    parts = [f"coalesce(CAST(length(CAST({alias}.{c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({alias}.{c} AS VARCHAR), '~')"
             for c in ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]]
    return _D_HASH.format(cols=", ".join(parts))


@plan("upsert_hash", "W2 T3 T4", oracle=f"""
WITH {_D_BATCHES},
th AS (SELECT t.*, {_d_hash('t')} AS row_hash FROM t),
sh AS (SELECT s.*, {_d_hash('s')} AS row_hash FROM s)
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'kept'
            WHEN t.row_hash IS NOT DISTINCT FROM s.row_hash THEN 'unchanged' ELSE 'update' END AS _change,
       CASE WHEN t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND t.row_hash IS DISTINCT FROM s.row_hash)
            THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND t.row_hash IS DISTINCT FROM s.row_hash)
            THEN s.row_hash ELSE t.row_hash END AS row_hash
FROM th t FULL JOIN sh s ON t.o_orderkey = s.o_orderkey
""")
def upsert_hash(spark, sf_dir):
    """Row-hash guarded upsert: a matched row is rewritten only when its hash changed."""
    target, source = _batches(spark, sf_dir)
    hcols = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    t = target.withColumn("row_hash", row_hash(hcols))
    s = source.withColumn("row_hash", row_hash(hcols))
    m = up.merge_upsert(t, s, "o_orderkey", update="hash")
    return m.select("o_orderkey", "_change", "o_totalprice", "row_hash")


@plan("upsert_set", "W3", oracle=f"""
WITH {_D_BATCHES}
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderdate ELSE s.o_orderdate END AS inserted_on,
       CASE WHEN s.o_orderkey IS NOT NULL THEN DATE '2002-01-01' ELSE t.o_orderdate END AS updated_on
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_set(spark, sf_dir):
    """Explicit-SET upsert: values and ``updated_on`` refresh; ``inserted_on`` is kept."""
    target, source = _batches(spark, sf_dir)
    t = target.select("o_orderkey", "o_totalprice", "o_orderstatus",
                      F.col("o_orderdate").alias("inserted_on"), F.col("o_orderdate").alias("updated_on"))
    s = source.select("o_orderkey", "o_totalprice", "o_orderstatus",
                      F.col("o_orderdate").alias("inserted_on"), F.col("o_orderdate").alias("updated_on"))
    m = up.merge_upsert(t, s, "o_orderkey", update=["o_totalprice", "o_orderstatus"],
                        touch={"updated_on": F.lit("2002-01-01").cast("date")})
    return m.drop("_change", "_src_rows")


@plan("upsert_ordered", "W4 W1", oracle="""
WITH h AS (SELECT o_orderkey, o_totalprice, 0 AS prio FROM orders),
snap AS (SELECT o_orderkey, o_totalprice + 50.0 AS o_totalprice, 1 AS prio FROM orders
         WHERE CAST(o_orderdate AS DATE) >= DATE '2000-01-01'),
u AS (SELECT * FROM h UNION ALL SELECT * FROM snap),
w AS (SELECT o_orderkey, o_totalprice, prio,
             row_number() OVER (PARTITION BY o_orderkey ORDER BY prio DESC, o_totalprice DESC) AS rn,
             count(*) OVER (PARTITION BY o_orderkey) AS n FROM u)
SELECT o_orderkey, o_totalprice, CAST(prio AS INTEGER) AS source_priority, n AS _src_rows FROM w WHERE rn = 1
""")
def upsert_ordered(spark, sf_dir):
    """History file then snapshot file: on overlapping keys the later (snapshot) wins."""
    o = read(spark, sf_dir, "orders")
    hist = o.select("o_orderkey", "o_totalprice")
    snap = (o.where(F.to_date("o_orderdate") >= F.lit("2000-01-01").cast("date"))
             .select("o_orderkey", (F.col("o_totalprice") + 50.0).alias("o_totalprice")))
    both = up.prioritise([hist, snap], "source_priority")
    empty = both.limit(0).select("o_orderkey", "o_totalprice", "source_priority")
    m = up.merge_upsert(empty, both, "o_orderkey", order=["source_priority"])
    return m.select("o_orderkey", "o_totalprice", "source_priority", "_src_rows")


@plan("upsert_metrics", "W5 Q6", oracle=f"""
WITH {_D_BATCHES}
SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'kept' ELSE 'update' END AS _change,
       count(*) AS n_rows
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey GROUP BY 1
""")
def upsert_metrics(spark, sf_dir):
    target, source = _batches(spark, sf_dir)
    return up.change_counts(up.merge_upsert(target, source, "o_orderkey"))


@plan("surrogate_keys", "W7", oracle="""
WITH old AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) AS BIGINT) AS geo_key
             FROM (SELECT DISTINCT c.c_name FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
                   WHERE CAST(o.o_orderdate AS DATE) < DATE '1995-07-01') t),
fresh AS (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM old)),
mx AS (SELECT coalesce(max(geo_key), 0) AS m FROM old)
SELECT c_name, geo_key FROM old
UNION ALL
SELECT c_name, CAST(m + row_number() OVER (ORDER BY c_name) AS BIGINT) FROM fresh, mx
""")
def surrogate_keys(spark, sf_dir):
    """Entity keys assigned as entities appear in the facts: the first load keys the
    customers with an order before 1995-07 (1..k by name); the second load brings every
    customer. Existing keys stay, new names continue from max(key) in name order."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    early = (read(spark, sf_dir, "orders").where(F.to_date("o_orderdate") < F.lit("1995-07-01").cast("date"))
             .select(F.col("o_custkey").alias("c_custkey")).distinct())
    empty = c.limit(0).select("c_name", F.lit(0).cast("long").alias("geo_key"))
    first = up.assign_surrogates(empty, c.join(early, "c_custkey").select("c_name"), "c_name", "geo_key")
    return up.assign_surrogates(first, c.select("c_name"), "c_name", "geo_key")


@plan("duplicate_keys", "W6", oracle="""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return up.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@plan("dedupe_keys", "O6 W6", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_keys(spark, sf_dir):
    """Deterministic keep-one per (order, line): latest ship date, then the full row."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"),
        "l_partkey", "l_quantity", "l_extendedprice")
    return up.dedupe(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@plan("replace_by_source", "W11 T17", oracle="""
SELECT doc_id, source, lang FROM documents WHERE source IS NULL OR source NOT IN ('src0','src1','src2','src3','src4')
UNION ALL
SELECT doc_id, source, upper(lang) FROM documents WHERE source IN ('src0','src1','src2','src3')
""")
def replace_by_source(spark, sf_dir):
    """Quarantine-style replace: all documents are the old table; a re-run processed src0–src4
    with other values (src4 produced no rows, so its old rows must still go)."""
    old = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    new = old.where(F.col("source").isin("src0", "src1", "src2", "src3")).withColumn("lang", F.upper("lang"))
    return up.replace_by(old, new, "source", ["src0", "src1", "src2", "src3", "src4"])


@plan("upsert_partitions", "W1 W5 W8", oracle=f"""
WITH {_D_BATCHES},
m AS (SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate,
             CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
             CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
      FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_orderdate = s.o_orderdate),
touched AS (SELECT DISTINCT year(o_orderdate) AS y FROM s)
SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice, year(o_orderdate) IN (SELECT y FROM touched) AS rewritten FROM m
""")
def upsert_partitions(spark, sf_dir):
    """A batch merged into a table partitioned by year: the years it touches get new files, all others
    keep theirs (``rewritten`` compares the files before and after)."""
    store = TableStore(spark, fs.staging_path(spark, "years"))
    target, source = _batches(spark, sf_dir)
    year = F.year("o_orderdate")
    store.write("orders", target, slot=year)
    before = cut_lineage(store.files("orders"))
    store.upsert("orders", source, ["o_orderkey", "o_orderdate"], slot=year)
    rows = spark.read.parquet(store.path("orders")).withColumn("file_path", F.col("_metadata.file_path"))
    known = before.select("file_path", F.lit(True).alias("known"))  # a row for each file
    return rows.join(fs.broadcast_if_small(known), "file_path", "left").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", F.col("known").isNull().alias("rewritten"))


@plan("replace_partitions", "W11 T17", oracle="""
SELECT doc_id, source, lang, false AS rewritten FROM documents WHERE source IS NULL OR source NOT IN ('src0','src1','src2','src3','src4')
UNION ALL
SELECT doc_id, source, upper(lang), true FROM documents WHERE source IN ('src0','src1','src2','src3')
""")
def replace_partitions(spark, sf_dir):
    """Replace-by-source on a table partitioned by source: src0 to src3 come with new rows, src4 with none
    and is emptied, the files of all other sources stay."""
    store = TableStore(spark, fs.staging_path(spark, "sources"))
    old = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    store.write("rows", old, slot=F.col("source"))
    before = cut_lineage(store.files("rows")).select("file_path", F.lit(True).alias("known"))
    new = old.where(F.col("source").isin("src0", "src1", "src2", "src3")).withColumn("lang", F.upper("lang"))
    store.replace_by("rows", new, "source", [f"src{i}" for i in range(5)])
    rows = spark.read.parquet(store.path("rows")).withColumn("file_path", F.col("_metadata.file_path"))
    return rows.join(fs.broadcast_if_small(before), "file_path", "left").select("doc_id", "source", "lang", F.col("known").isNull().alias("rewritten"))
