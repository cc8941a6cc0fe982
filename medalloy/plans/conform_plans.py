"""Silver conform plans: typing with cast-error capture, sentinel rejects, key
resolution and the quarantine split (Q1–Q4, J4, T1, T2, T8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.functions.dates import date_key
from medalloy.operators import conform as cf
from medalloy.operators.rollup import bridge_rollup
from medalloy.plans.registry import plan
from medalloy.plans.tables import read
from medalloy.sources import files as fs
from medalloy.store import TableStore

# The raw "listing feed": lineitem rendered as all-string text the way a CSV source
# writes it, with value-driven dirt: 'n/a', blanks, padded numbers, the '.' sentinel,
# a Java float suffix ('1d', a cast error under T2) and malformed yyyymm keys.
RAW_FEED_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity = 50 AND l_returnflag = 'R' THEN '2024-1'
            ELSE {yyyymm} END AS month_date_yyyymm,
       CASE WHEN l_quantity = 13 THEN 'n/a' WHEN l_quantity = 7 THEN ''
            WHEN l_quantity = 21 THEN ' 21 ' ELSE CAST(l_quantity AS STRING) END AS quantity,
       CASE WHEN l_discount = 0.1 THEN '.' ELSE CAST(l_extendedprice AS STRING) END AS extended_price,
       CASE WHEN l_tax = 0.08 THEN '1d' WHEN l_tax = 0.0 THEN NULL ELSE CAST(l_tax AS STRING) END AS tax
FROM lineitem
"""

FEED_SPECS = [
    cf.ColumnSpec("month_end", "yyyymm", source="month_date_yyyymm", key=True),
    cf.ColumnSpec("quantity", "long"),
    cf.ColumnSpec("extended_price", "double"),
    cf.ColumnSpec("tax", "double"),
]


def raw_feed(spark, sf_dir):
    sql = RAW_FEED_SQL.format(yyyymm="date_format(l_shipdate, 'yyyyMM')").replace("FROM lineitem", "FROM {t}")
    return spark.sql(sql, t=read(spark, sf_dir, "lineitem"))


_DUCK_FEED = RAW_FEED_SQL.format(yyyymm="strftime(l_shipdate, '%Y%m')").replace("AS STRING", "AS VARCHAR")
_NUM = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"


def _d_double(c):
    return (f"(CASE WHEN regexp_matches({c}, {_NUM}) AND isfinite(TRY_CAST(trim({c}) AS DOUBLE)) "
            f"THEN TRY_CAST(trim({c}) AS DOUBLE) END)")


def _d_err(c, typed):
    return f"({c} IS NOT NULL AND trim({c}) <> '' AND {typed} IS NULL)"


_D_MONTH = ("(CASE WHEN regexp_matches(trim(month_date_yyyymm), '^[0-9]{6}$') THEN "
            "last_day(TRY_CAST(strptime(trim(month_date_yyyymm) || '01', '%Y%m%d') AS DATE)) END)")
_D_TYPED = f"""
typed AS (
  SELECT l_orderkey, l_linenumber,
         {_D_MONTH} AS month_end,
         CAST(round({_d_double('quantity')}) AS BIGINT) AS quantity,
         {_d_double('extended_price')} AS extended_price,
         {_d_double('tax')} AS tax,
         concat_ws(',',
           CASE WHEN {_D_MONTH} IS NULL THEN 'month_end' END,
           CASE WHEN {_d_err('quantity', _d_double('quantity'))} THEN 'quantity' END,
           CASE WHEN {_d_err('extended_price', _d_double('extended_price'))} THEN 'extended_price' END,
           CASE WHEN {_d_err('tax', _d_double('tax'))} THEN 'tax' END) AS errs
  FROM ({_DUCK_FEED}))
"""


@plan("cast_errors", "S1 Q1 T1 T2 T8", oracle=f"""
WITH {_D_TYPED}
SELECT l_orderkey, l_linenumber, month_end,
       CAST(year(month_end) * 10000 + month(month_end) * 100 + day(month_end) AS INTEGER) AS date_key,
       quantity, extended_price, tax, errs AS cast_errors,
       CAST(CASE WHEN errs = '' THEN 0 ELSE length(errs) - length(replace(errs, ',', '')) + 1 END AS INTEGER) AS n_errors
FROM typed
""")
def cast_errors(spark, sf_dir):
    """Every feed row typed, with the list of columns whose reported value failed."""
    typed = cf.type_columns(raw_feed(spark, sf_dir), FEED_SPECS, keep=["l_orderkey", "l_linenumber"])
    return typed.select(
        "l_orderkey", "l_linenumber", "month_end", date_key("month_end").alias("date_key"),
        "quantity", "extended_price", "tax",
        F.array_join("cast_errors", ",").alias("cast_errors"),
        F.size("cast_errors").alias("n_errors"),
    )


@plan("quarantine_split", "Q1 Q3 Q6 Q9", oracle=f"""
WITH {_D_TYPED}
SELECT CASE WHEN errs = '' THEN 'good' ELSE 'quarantine' END AS branch,
       CASE WHEN errs = '' THEN NULL ELSE 'cast_failed:' || errs END AS quarantine_reason,
       count(*) AS n_rows
FROM typed GROUP BY ALL
""")
def quarantine_split(spark, sf_dir):
    """Conservation of the split: every feed row lands in exactly one branch, by reason."""
    typed = cf.type_columns(raw_feed(spark, sf_dir), FEED_SPECS, keep=["l_orderkey", "l_linenumber"])
    staged = typed.withColumn("quarantine_reason", cf.quarantine_reason())
    return (staged.groupBy(F.when(F.col("quarantine_reason").isNull(), "good").otherwise("quarantine").alias("branch"),
                           "quarantine_reason")
                  .agg(F.count(F.lit(1)).alias("n_rows")))


@plan("quarantine_records", "Q3 W10", oracle=f"""
WITH {_D_TYPED}
SELECT 'listing' AS source_system, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS natural_key,
       'cast_failed:' || errs AS quarantine_reason
FROM typed WHERE errs <> ''
""")
def quarantine_records(spark, sf_dir):
    """Quarantine rows (payload is kept in the library output; not compared: JSON text
    formatting differs between engines)."""
    raw = raw_feed(spark, sf_dir)
    raw = raw.withColumn("_raw", F.struct(*raw.columns))
    typed = cf.type_columns(raw, FEED_SPECS, keep=["l_orderkey", "l_linenumber", "_raw"])
    staged = typed.withColumn("quarantine_reason", cf.quarantine_reason())
    _, bad = cf.split(staged)
    q = cf.quarantine_rows(bad, source_system="listing", natural_key_cols=["l_orderkey", "l_linenumber"],
                           payload=F.col("_raw"))
    return q.select("source_system", "natural_key", "quarantine_reason")


_RAW_TOO = _D_TYPED.replace("SELECT l_orderkey, l_linenumber,\n", "SELECT l_orderkey, l_linenumber, month_date_yyyymm AS raw_month, quantity AS raw_quantity,\n", 1)


@plan("append_log", "W10 Q3 2.9", oracle=f"""
WITH {_RAW_TOO}
SELECT 'batch-' || CAST(l_linenumber % 2 AS VARCHAR) AS batch, 'listing' AS source_system,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS natural_key,
       'cast_failed:' || errs AS quarantine_reason, raw_month, raw_quantity
FROM typed WHERE errs <> ''
""")
def append_log(spark, sf_dir):
    """Quarantine rows appended in two batches, the second one sent twice, read back with two fields of
    the JSON payload: a repeated batch adds nothing."""
    raw = raw_feed(spark, sf_dir)
    typed = cf.type_columns(raw.withColumn("_raw", F.struct(*raw.columns)), FEED_SPECS, keep=["l_orderkey", "l_linenumber", "_raw"])
    _, bad = cf.split(typed.withColumn("quarantine_reason", cf.quarantine_reason()))
    store = TableStore(spark, fs.staging_path(spark, "log"))
    for i in (0, 1, 1):
        rows = cf.quarantine_rows(bad.where(F.col("l_linenumber") % 2 == i), source_system="listing",
                                  natural_key_cols=["l_orderkey", "l_linenumber"], payload=F.col("_raw"))
        store.append("quarantine", rows.withColumn("batch", F.lit(f"batch-{i}")), batch=f"batch-{i}")
    return store.read("quarantine").select(
        "batch", "source_system", "natural_key", "quarantine_reason",
        F.get_json_object("raw_payload", "$.month_date_yyyymm").alias("raw_month"), F.get_json_object("raw_payload", "$.quantity").alias("raw_quantity"))


# Macro series raw text: the '.' missing sentinel and malformed dates arise from value rules.
SERIES_RAW_SQL = """
SELECT o_orderpriority AS series_id,
       CASE WHEN o_orderstatus = 'P' AND o_totalprice < 1000 THEN 'not-a-date'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS observation_date,
       CASE WHEN o_orderstatus = 'P' AND o_totalprice >= 1000 AND o_totalprice < 5000 THEN '.'
            WHEN o_orderstatus = 'F' AND o_totalprice < 2000 THEN 'n/a'
            WHEN o_orderstatus = 'O' AND o_totalprice < 1500 THEN ''
            ELSE CAST(o_totalprice AS STRING) END AS value,
       o_orderkey
FROM orders
"""


@plan("sentinel_reject", "Q2", oracle=f"""
WITH raw AS ({SERIES_RAW_SQL.replace('AS STRING', 'AS VARCHAR')})
SELECT o_orderkey, series_id,
       CASE WHEN TRY_CAST(trim(observation_date) AS DATE) IS NULL THEN 'cast_failed:observation_date'
            WHEN value = '.' THEN 'null_value'
            WHEN value IS NOT NULL AND trim(value) <> '' AND {_d_double('value')} IS NULL THEN 'cast_failed:value' END AS reject_reason,
       TRY_CAST(trim(observation_date) AS DATE) AS observation_date,
       {_d_double('value')} AS value
FROM raw
""")
def sentinel_reject(spark, sf_dir):
    raw = spark.sql(SERIES_RAW_SQL.replace("FROM orders", "FROM {t}"), t=read(spark, sf_dir, "orders"))
    from medalloy.functions.casts import strict_double
    from medalloy.functions.dates import safe_date
    return raw.select(
        "o_orderkey", "series_id",
        cf.sentinel_reason(F.col("observation_date"), F.col("value")).alias("reject_reason"),
        safe_date(F.trim("observation_date")).alias("observation_date"),
        strict_double("value").alias("value"),
    )


@plan("key_resolution", "J4 Q3", oracle=r"""
WITH raw AS (
  SELECT doc_id, source, lang,
         CASE WHEN lang = 'de' AND source IN ('src3', 'src7') THEN CAST(n_chars AS VARCHAR) || 'c'
              ELSE CAST(n_chars AS VARCHAR) END AS n_chars_raw
  FROM documents),
typed AS (
  SELECT r.doc_id, r.source, l.doc_id AS label_key,
         CASE WHEN regexp_matches(n_chars_raw, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$')
              THEN CAST(round(TRY_CAST(trim(n_chars_raw) AS DOUBLE)) AS BIGINT) END AS n_chars, n_chars_raw
  FROM raw r LEFT JOIN labels l ON r.doc_id = l.doc_id)
SELECT doc_id, source, label_key, n_chars,
       CASE WHEN label_key IS NULL THEN 'unmatched_geography'
            WHEN n_chars IS NULL AND n_chars_raw IS NOT NULL AND trim(n_chars_raw) <> '' THEN 'cast_failed:n_chars' END
         AS quarantine_reason
FROM typed
""")
def key_resolution(spark, sf_dir):
    """Documents resolved against the label dimension; unmatched first, then cast errors."""
    d = read(spark, sf_dir, "documents").select(
        "doc_id", "source",
        F.when((F.col("lang") == "de") & F.col("source").isin("src3", "src7"),
               F.concat(F.col("n_chars").cast("string"), F.lit("c")))
         .otherwise(F.col("n_chars").cast("string")).alias("n_chars_raw"))
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").alias("label_key"))
    typed = cf.type_columns(d, [cf.ColumnSpec("n_chars", "long", source="n_chars_raw")], keep=["doc_id", "source"])
    resolved = cf.resolve_key(typed, labels, "doc_id", "label_key")
    return resolved.select("doc_id", "source", "label_key", "n_chars",
                           cf.quarantine_reason(key_col="label_key").alias("quarantine_reason"))


@plan("rollup_then_resolve", "A2 J1 J4 Q4", oracle="""
WITH c AS (SELECT c_nationkey, count(*) AS customers, round(sum(c_acctbal), 2) AS acctbal FROM customer GROUP BY 1),
dim AS (SELECT n_nationkey, n_regionkey FROM nation WHERE n_regionkey <> 4)
SELECT c.c_nationkey, c.customers, c.acctbal, dim.n_regionkey AS region_key,
       CASE WHEN dim.n_regionkey IS NULL THEN 'unmatched_geography' END AS quarantine_reason
FROM c LEFT JOIN dim ON c.c_nationkey = dim.n_nationkey
""")
def rollup_then_resolve(spark, sf_dir):
    """Q4: roll customers up to nation first, then resolve against a dimension that covers
    only part of the nations; unmatched groups are quarantined after the rollup."""
    cust = read(spark, sf_dir, "customer")
    rolled = bridge_rollup(cust, None, by="c_nationkey", sums={"acctbal": "c_acctbal"},
                           counts={"customers": None}, digits=2)
    dim = read(spark, sf_dir, "nation").where(F.col("n_regionkey") != 4).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region_key"))
    res = cf.resolve_key(rolled, dim, "c_nationkey", "region_key")
    return res.select("c_nationkey", "customers", "acctbal", "region_key",
                      F.when(F.col("region_key").isNull(), "unmatched_geography").alias("quarantine_reason"))


@plan("period_key", "T6 P3 Q3", oracle=r"""
WITH raw AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 'quarterly' WHEN 'O' THEN 'monthly' WHEN 'P' THEN 'Quarterly' END AS frequency,
         year(o_orderdate) AS yr,
         CASE WHEN o_orderstatus = 'F' THEN quarter(o_orderdate) ELSE month(o_orderdate) END AS period,
         CASE WHEN o_orderpriority = '5-LOW' THEN '-'
              WHEN o_orderpriority = '1-URGENT' THEN '( ' || CAST(o_totalprice AS VARCHAR) || ')'
              ELSE CAST(o_totalprice AS VARCHAR) END AS index_raw
  FROM orders),
p AS (
  SELECT *, CASE lower(trim(frequency))
              WHEN 'quarterly' THEN CASE WHEN period BETWEEN 1 AND 4 THEN last_day(make_date(CAST(yr AS INTEGER), CAST(period * 3 AS INTEGER), 1)) END
              WHEN 'monthly' THEN CASE WHEN period BETWEEN 1 AND 12 THEN last_day(make_date(CAST(yr AS INTEGER), CAST(period AS INTEGER), 1)) END
            END AS period_end,
         CASE WHEN trim(index_raw) = '-' THEN NULL ELSE regexp_replace(trim(index_raw), '^\(\s*(.*?)\s*\)$', '\1') END AS idx_txt
  FROM raw)
SELECT o_orderkey, frequency, period_end,
       CAST(year(period_end) * 10000 + month(period_end) * 100 + day(period_end) AS INTEGER) AS date_key,
       CASE WHEN regexp_matches(idx_txt, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$')
            THEN TRY_CAST(trim(idx_txt) AS DOUBLE) END AS index_value,
       CASE WHEN period_end IS NULL THEN 'cast_failed:period' END AS reject_reason
FROM p
""")
def period_key(spark, sf_dir):
    """Index rows keyed by (frequency, year, period): finished orders are quarterly, open ones
    monthly, pending ones claim 'Quarterly' but carry month numbers — periods above 4 are
    rejected instead of producing a wrong quarter. Index text uses workbook sentinels
    ('-' = missing, '( 2.56)' = 2.56)."""
    from medalloy.functions.dates import period_date
    from medalloy.functions.text import sentinel_number
    o = read(spark, sf_dir, "orders")
    freq = (F.when(F.col("o_orderstatus") == "F", "quarterly").when(F.col("o_orderstatus") == "O", "monthly")
             .when(F.col("o_orderstatus") == "P", "Quarterly"))
    period = F.when(F.col("o_orderstatus") == "F", F.quarter("o_orderdate")).otherwise(F.month("o_orderdate"))
    raw = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("-"))
            .when(F.col("o_orderpriority") == "1-URGENT",
                  F.concat(F.lit("( "), F.col("o_totalprice").cast("string"), F.lit(")")))
            .otherwise(F.col("o_totalprice").cast("string")))
    staged = o.select("o_orderkey", freq.alias("frequency"), F.year("o_orderdate").alias("yr"),
                      period.alias("period"), raw.alias("index_raw"))
    pe = period_date(F.col("frequency"), F.col("yr"), F.col("period"))
    out = staged.select("o_orderkey", "frequency", pe.alias("period_end"),
                        sentinel_number(F.col("index_raw")).alias("index_value"))
    return out.select("o_orderkey", "frequency", "period_end", date_key("period_end").alias("date_key"), "index_value",
                      F.when(F.col("period_end").isNull(), "cast_failed:period").alias("reject_reason"))
