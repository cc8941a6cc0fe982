"""Table-level plans: contracts, carries, filters, probes and schema evolution
(S4, A1, W8, W12, W13, P2–P5, J2, A4, O3)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.functions.text import county_key, title_parts
from medalloy.operators import checks as ck
from medalloy.operators import constraints as cn
from medalloy.operators import rollup as ru
from medalloy.plans.registry import plan
from medalloy.plans.tables import TABLES, read
from medalloy.sources import files as fs
from medalloy.store import TableSpec, TableStore, column, conform_to, describe

_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
       "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@plan("parquet_contract", "S4 A1", oracle="""
SELECT 'lineitem' AS table_name, count(*) AS "rows", CAST(1 AS BIGINT) AS n_files FROM lineitem
""")
def parquet_contract(spark, sf_dir):
    """Exact Parquet column contract, then row count and distinct source files in one pass."""
    df = fs.read_parquet_contract(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", _LI)
    return fs.file_inventory(df).select(F.lit("lineitem").alias("table_name"), "rows", "n_files")


@plan("gold_carry", "P2 W8 Q6", oracle="""
SELECT c_custkey AS geo_key, c_name AS geo_name, c_nationkey AS state_key, c_mktsegment AS segment FROM customer
""")
def gold_carry(spark, sf_dir):
    """Silver dim → Gold: fixed column order, full rebuild by one Spark write, read back; a second
    rebuild takes the first one's place."""
    store = TableStore(spark, fs.staging_path(spark, "gold"))
    dim = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("geo_key"), F.col("c_name").alias("geo_name"),
        F.col("c_nationkey").alias("state_key"), F.col("c_mktsegment").alias("segment"))
    store.write("dim_geo", dim.withColumn("segment", F.lit("old")))
    store.write("dim_geo", dim)
    return store.read("dim_geo")


@plan("canonical_filter", "P3 P4", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_orderkey IS NOT NULL
""")
def canonical_filter(spark, sf_dir):
    """Canonical-variant filter (two equalities) plus a not-null key: all pushed to the scan."""
    o = read(spark, sf_dir, "orders")
    return (o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
                    & F.col("o_orderkey").isNotNull())
             .select("o_orderkey", "o_custkey", "o_totalprice"))


@plan("nonblank_filter", "P5 P4", oracle="""
SELECT doc_id, source FROM documents WHERE lang IS NOT NULL AND lang <> '' AND lang = 'en'
""")
def nonblank_filter(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.where(F.col("lang").isNotNull() & (F.col("lang") != "") & (F.col("lang") == "en")).select("doc_id", "source")


@plan("station_bridge", "J2 A4", oracle="""
WITH bridge AS (SELECT n_nationkey, n_regionkey AS metro FROM nation WHERE n_regionkey <> 4)
SELECT b.metro, count(*) AS stations, round(avg(s_acctbal), 4) AS acctbal_mean
FROM supplier s JOIN bridge b ON s.s_nationkey = b.n_nationkey GROUP BY 1
""")
def station_bridge(spark, sf_dir):
    """Stations (suppliers) → metro bridge (inner: uncovered stations drop) → mean of stations."""
    s = read(spark, sf_dir, "supplier")
    bridge = read(spark, sf_dir, "nation").where("n_regionkey <> 4").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("metro"))
    return ru.bridge_rollup(s, bridge, on="s_nationkey", by="metro", counts={"stations": None},
                            means={"acctbal_mean": "s_acctbal"}, digits=4)


@plan("existence_probe", "O3", oracle="""
SELECT 'labels' AS table_name, (SELECT count(*) FROM labels) > 0 AS has_rows
UNION ALL SELECT 'orders_2099', (SELECT count(*) FROM orders WHERE year(o_orderdate) = 2099) > 0
""")
def existence_probe(spark, sf_dir):
    """``LIMIT 1`` existence probes (the scan stops at the first row)."""
    lab = read(spark, sf_dir, "labels").limit(1)
    o = read(spark, sf_dir, "orders").where((F.col("o_orderdate") >= F.lit("2099-01-01").cast("timestamp_ntz"))
                                            & (F.col("o_orderdate") < F.lit("2100-01-01").cast("timestamp_ntz"))).limit(1)
    mk = lambda name, df: df.agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(F.lit(name).alias("table_name"), "has_rows")
    return mk("labels", lab).unionByName(mk("orders_2099", o))


CUSTOMER_V2 = T.StructType([
    column("c_custkey", T.LongType(), "customer (metro) key"),
    column("c_name", T.StringType(), "display name"),
    column("c_nationkey", T.IntegerType(), "parent nation key"),
    column("c_acctbal", T.DoubleType(), "account balance"),
    column("c_comment", T.StringType(), "added in v2; NULL for rows loaded before"),
])


@plan("schema_migration", "W12 W13 W14", oracle="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_comment FROM customer
""")
def schema_migration(spark, sf_dir):
    """Create-if-absent from a declared spec (comments in field metadata), then an additive
    migration: rows of the old shape gain the new column as NULL."""
    store = TableStore(spark, fs.staging_path(spark, "catalog"))
    spec = TableSpec("customer", CUSTOMER_V2, keys=("c_custkey",))
    store.create_if_absent([spec])
    old = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    ck.enforce(ck.unique_violations(old, "c_custkey"), "customer.pk")
    store.write("customer", conform_to(old, spec.schema))
    return store.read("customer")


# The declared keys of the driver tables; every check below follows from these alone.
KEYS = {"lineitem": (("l_orderkey", "l_linenumber"), {"l_orderkey": ("orders", "o_orderkey"), "l_partkey": ("part", "p_partkey"), "l_suppkey": ("supplier", "s_suppkey")}),
        "orders": (("o_orderkey",), {"o_custkey": ("customer", "c_custkey")}), "labels": (("doc_id",), {"doc_id": ("documents", "doc_id")}),
        "customer": (("c_custkey",), {"c_nationkey": ("nation", "n_nationkey")}), "supplier": (("s_suppkey",), {"s_nationkey": ("nation", "n_nationkey")}),
        "nation": (("n_nationkey",), {"n_regionkey": ("region", "r_regionkey")}), "region": (("r_regionkey",), {}),
        "part": (("p_partkey",), {}), "documents": (("doc_id",), {})}


def _pk_sql(seq: int, table: str, cols: tuple) -> str:
    c, null = ", ".join(cols), " OR ".join(f"{x} IS NULL" for x in cols)
    return f"""SELECT {seq} AS seq, 'pk_{table}' AS "constraint", 'primary' AS kind, '{table}' AS table_name, '{",".join(cols)}' AS columns, NULL AS refers_to,
  sum(n)::bigint AS checked_rows, coalesce(sum(n) FILTER ({null}), 0)::bigint AS null_rows,
  count(*) FILTER (n > 1 OR {null}) AS broken_keys, coalesce(sum(n) FILTER (n > 1 OR {null}), 0)::bigint AS broken_rows
  FROM (SELECT {c}, count(*) AS n FROM {table} GROUP BY {c})"""


def _fk_sql(seq: int, table: str, c: str, parent: str, pc: str) -> str:
    lost = f"{c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL)"
    return f"""SELECT {seq}, 'fk_{table}_{c}', 'foreign', '{table}', '{c}', '{parent}({pc})', count(*), count(*) FILTER ({c} IS NULL),
  count(DISTINCT {c}) FILTER ({lost}), count(*) FILTER ({lost}) FROM {table}"""


# parents before children, in the order of KEYS
_CHECK_ORDER = ["region", "nation", "customer", "orders", "part", "supplier", "lineitem", "documents", "labels"]
_CHECKS = [(t, c) for t in _CHECK_ORDER for c in (None, *KEYS[t][1])]
_CHECKS_SQL = " UNION ALL ".join(_pk_sql(i, t, KEYS[t][0]) if c is None else _fk_sql(i, t, c, *KEYS[t][1][c]) for i, (t, c) in enumerate(_CHECKS, 1))


@plan("declared_keys", "W14 Q5 W6", oracle=_CHECKS_SQL)
def declared_keys(spark, sf_dir):
    """Every declared primary and foreign key checked in one shuffle, parents before children."""
    tables = {name: read(spark, sf_dir, name) for name in KEYS}
    return cn.check_report(tables, [TableSpec(n, tables[n].schema, keys=k, foreign_keys=f) for n, (k, f) in KEYS.items()])


@plan("counts_by_name", "S14 A13", oracle=" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def counts_by_name(spark, sf_dir):
    """Row counts of all tables by one statement whose table name is a session variable."""
    for name in TABLES:
        read(spark, sf_dir, name).createOrReplaceTempView(f"scan_{name}")
    got = ck.counts_by_name(spark, [f"scan_{name}" for name in TABLES])
    return got.select(F.regexp_replace("table_name", "^scan_", "").alias("table_name"), "row_count")


NATION = T.StructType([column("n_nationkey", T.IntegerType(), "nation key"), column("n_name", T.StringType(), "display name"),
                       column("n_regionkey", T.IntegerType(), "parent region key")])
_TYPES = {"LongType": "bigint", "StringType": "string", "IntegerType": "int", "DoubleType": "double"}


def _described_sql(table: str, schema: T.StructType, missing: tuple = ()) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{f.name}' AS column_name, '{_TYPES[type(f.dataType).__name__]}' AS type, "
        f"'{f.metadata['comment']}' AS comment, {'count(*) - count(*)' if f.name in missing else f'count({f.name})'} AS present FROM {table}"
        for i, f in enumerate(schema.fields, 1))


@plan("table_comments", "W12 W13", oracle=_described_sql("nation", NATION) + " UNION ALL " + _described_sql("customer", CUSTOMER_V2, ("c_comment",)))
def table_comments(spark, sf_dir):
    """Declared tables created in the order of their keys and loaded; columns, types and comments as their
    files state them, with the rows that hold each column."""
    store = TableStore(spark, fs.staging_path(spark, "declared"))
    specs = cn.dependency_order([TableSpec("customer", CUSTOMER_V2, ("c_custkey",), {"c_nationkey": ("nation", "n_nationkey")}),
                                 TableSpec("nation", NATION, ("n_nationkey",))])
    store.create_if_absent(specs)
    for s in specs:
        have = read(spark, sf_dir, s.name)
        store.write(s.name, conform_to(have.select(*[c for c in s.schema.fieldNames() if c in have.columns]), s.schema))
    return describe(store, [s.name for s in specs])


@plan("title_parse", "2.9 A17", oracle="""
WITH t AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN replace(p_name, ' ', '-')
                                  WHEN p_size % 2 = 0 THEN 'Old, ' || replace(p_name, ' ', '- ') || ', ' || replace(p_brand, '#', '-')
                                  ELSE replace(p_name, ' ', '--') || ', ' || replace(p_brand, '#', '-') END AS title FROM part),
s AS (SELECT p_partkey, title, string_split(title, ',') AS c FROM t),
x AS (SELECT p_partkey, title,
             list_filter(list_transform(string_split(array_to_string(CASE WHEN len(c) > 1 THEN c[:-2] ELSE c END, ','), '-'), lambda v: trim(v)), lambda v: v <> '') AS cities,
             list_filter(list_transform(string_split(CASE WHEN len(c) > 1 THEN c[-1] ELSE '' END, '-'), lambda v: trim(v)), lambda v: v <> '') AS states
      FROM s)
SELECT p_partkey, title, array_to_string(cities, '|') AS cities, array_to_string(states, '|') AS states,
       coalesce(states[1], '') AS primary_state FROM x
""")
def title_parse(spark, sf_dir):
    """Area titles made of part names and brands, cut into cities and states."""
    p = read(spark, sf_dir, "part")
    states = F.regexp_replace("p_brand", "#", "-")

    def cities(dash: str):
        return F.regexp_replace("p_name", " ", dash)

    title = (F.when(F.col("p_size") % 7 == 0, cities("-"))
             .when(F.col("p_size") % 2 == 0, F.concat(F.lit("Old, "), cities("- "), F.lit(", "), states))
             .otherwise(F.concat(cities("--"), F.lit(", "), states)))
    t = p.select("p_partkey", title.alias("title"))
    got = title_parts(F.col("title"))
    return t.select("p_partkey", "title", F.array_join(got["cities"], "|").alias("cities"),
                    F.array_join(got["states"], "|").alias("states"), got["primary_state"].alias("primary_state"))


@plan("county_key", "2.9", oracle="""
SELECT c_custkey, printf('%02d%03d', c_nationkey, c_custkey) AS county_key FROM customer
""")
def county_keys(spark, sf_dir):
    """State and county code of every customer: nation and customer number, zero-padded."""
    return read(spark, sf_dir, "customer").select("c_custkey", county_key(F.col("c_nationkey"), F.col("c_custkey")).alias("county_key"))
