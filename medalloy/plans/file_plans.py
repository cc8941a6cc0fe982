"""File-source plans (S1–S7, S10–S13, S15, L6, W9). Inputs are written by Spark from the
tables into a staging folder under the shared checkpoint dir, then scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.operators import audit as au
from medalloy.plans.registry import plan
from medalloy.plans.tables import SERIES, read
from medalloy.sources import files as fs


def _stage_csv(spark, df, name, **opts):
    path = fs.staging_path(spark, name)
    w = df.write.mode("overwrite").option("header", True)
    if "partitionBy" in opts:
        w = w.partitionBy(opts.pop("partitionBy"))
    w.csv(path)  # W9: dataset overwrite
    return path


@plan("csv_all_string", "S1 S5 W9", oracle="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, true AS has_provenance FROM customer
""")
def csv_all_string(spark, sf_dir):
    path = _stage_csv(spark, read(spark, sf_dir, "customer"), "customer")
    df = fs.with_provenance(fs.read_csv_all_string(spark, path), "run-1")
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                     (F.col("source_file_path").isNotNull() & (F.col("run_id") == "run-1")).alias("has_provenance"))


_SHORT = {v: k for k, v in SERIES.items()}
_MANIFEST = [(f"series={short}", sid) for sid, short in SERIES.items() if short != "low"]


@plan("csv_positional", "S2 S5 S7", oracle="""
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS series_id,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS observation_date,
       CAST(o_totalprice AS VARCHAR) AS value, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS realtime_start,
       '9999-12-31' AS realtime_end
FROM orders
""")
def csv_positional(spark, sf_dir):
    """One CSV folder per series with header ``date,value,realtime_start,realtime_end``;
    names applied by position (``date`` → ``observation_date``) and the series id comes
    from the folder name via the manifest (the ``low`` folder is not in it → NULL id)."""
    o = read(spark, sf_dir, "orders")
    short = F.create_map(*[F.lit(x) for kv in SERIES.items() for x in kv])[F.col("o_orderpriority")]
    staged = o.select(short.alias("series"), F.to_date("o_orderdate").cast("string").alias("date"),
                      F.col("o_totalprice").cast("string").alias("value"),
                      F.to_date("o_orderdate").cast("string").alias("realtime_start"),
                      F.lit("9999-12-31").alias("realtime_end"))
    path = _stage_csv(spark, staged, "series", partitionBy="series")
    df = fs.read_csv_positional(spark, path + "/*/", ["observation_date", "value", "realtime_start", "realtime_end"])
    df = df.withColumn("folder", F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]+$", ""))
    manifest = spark.createDataFrame(_MANIFEST, "file_name string, series_id string")
    return fs.manifest_lookup(df, manifest, path_col="folder").select("series_id", "observation_date", "value", "realtime_start", "realtime_end")


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@plan("csv_subset_rename", "S3", oracle="""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS VARCHAR) AS l_quantity,
       l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem
""")
def csv_subset_rename(spark, sf_dir):
    """Upper-case hyphenated headers; keep 4 of 11 by name, cleaned to lower snake case."""
    li = read(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    wide = li.select(*[F.col(c).cast("string").alias(c.upper().replace("_", "-")) for c in _LI_COLS])
    path = _stage_csv(spark, wide, "lineitem_wide")
    return fs.select_subset(fs.read_csv_all_string(spark, path),
                            ["L-ORDERKEY", "L-QUANTITY", "L-RETURNFLAG", "L-SHIPDATE"])


@plan("header_contract", "S6", oracle="""
SELECT * FROM (VALUES ('nation', true), ('supplier', true), ('region', false)) t(dataset, ok)
WHERE (SELECT count(*) FROM region) > 0
""")
def header_contract(spark, sf_dir):
    """Exact and required-subset header contracts checked over every written file at once."""
    n = _stage_csv(spark, read(spark, sf_dir, "nation"), "nation")
    s = _stage_csv(spark, read(spark, sf_dir, "supplier"), "supplier")
    r = _stage_csv(spark, read(spark, sf_dir, "region").toDF("regionkey", "name"), "region")
    reps = [
        fs.header_report(spark, n, ["n_nationkey", "n_name", "n_regionkey"]).withColumn("dataset", F.lit("nation")),
        fs.header_report(spark, s, ["s_suppkey", "s_name"], mode="subset").withColumn("dataset", F.lit("supplier")),
        fs.header_report(spark, r, ["r_regionkey", "r_name"]).withColumn("dataset", F.lit("region")),
    ]
    allrep = reps[0].unionByName(reps[1]).unionByName(reps[2])
    return allrep.groupBy("dataset").agg(F.bool_and("ok").alias("ok"))


def _ragged_contents(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(fs.broadcast_if_small(n), c.c_nationkey == n.n_nationkey)
    station = F.concat(F.when(F.col("c_nationkey") < 20, "US").otherwise("CA"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    name = F.concat(F.col("c_name"), F.lit(', ""'), F.col("n_name"), F.lit('""'))
    acct = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string"))
    seg = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    # header lists only the columns this station reports; NAME is quoted (it holds a comma and quotes)
    header = F.concat_ws(",", F.lit("STATION"), F.lit("NAME"), F.when(acct.isNotNull(), F.lit("ANN-ACCTBAL-NORMAL")),
                         F.when(seg.isNotNull(), F.lit("SEGMENT")), F.lit("EXTRA-COL"))
    values = F.concat_ws(",", station, F.concat(F.lit('"'), name, F.lit('"')), acct, seg, F.lit("x"))
    return j.select(F.concat(F.lit("stations/"), station, F.lit(".csv")).alias("file_path"),
                    F.concat(header, F.lit("\n"), values, F.lit("\n")).alias("content"))


@plan("ragged_normalise", "S10 P8", oracle="""
SELECT (CASE WHEN c_nationkey < 20 THEN 'US' ELSE 'CA' END) || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS STATION,
       c_name || ', "' || n_name || '"' AS NAME,
       CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) END AS "ANN-ACCTBAL-NORMAL",
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS SEGMENT,
       CAST(NULL AS VARCHAR) AS "ANN-MISSING-NORMAL"
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey < 20
""")
def ragged_normalise(spark, sf_dir):
    """One-record CSV per station with differing headers → fixed wanted columns; non-US dropped."""
    files = _ragged_contents(spark, sf_dir)
    out = fs.parse_ragged(files, ["STATION", "NAME", "ANN-ACCTBAL-NORMAL", "SEGMENT", "ANN-MISSING-NORMAL"],
                          id_col="STATION", keep_prefix="US")
    return fs.require_rows(out, "stations").drop("source_file_path")


_PAGE_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([T.StructField("attributes", T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("props", T.StringType())]))]))),
    T.StructField("exceededTransferLimit", T.BooleanType()),
])


@plan("json_flatten", "S11", oracle="""
SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_flatten(spark, sf_dir):
    """Events served as JSON pages of at most 100 features ``{features:[{attributes}],
    exceededTransferLimit}``; flattened back to one row per feature."""
    e = read(spark, sf_dir, "events")
    pages = (e.groupBy((F.col("event_id") / 100).cast("long").alias("page_no"))
              .agg(F.collect_list(F.struct(F.struct("event_id", "user_id", "event_type", "props").alias("attributes")))
                   .alias("features"))
              .select(F.to_json(F.struct("features", F.lit(True).alias("exceededTransferLimit"))).alias("page")))
    from medalloy.sources.json_pages import flatten_pages
    flat = flatten_pages(pages, "page", _PAGE_SCHEMA)
    return flat.select("event_id", "user_id", "event_type",
                       F.get_json_object("props", "$.k").cast("long").alias("k"))


@plan("json_chains", "S11", oracle="""
WITH p AS (SELECT event_type AS chain, event_id // 500 AS no, count(*) AS n,
                  event_id // 500 < (SELECT max(event_id) // 500 FROM events) AND event_id // 500 % 7 <> 3 AS more
           FROM events WHERE event_type <> 'view' OR event_id // 500 % 5 <> 2 GROUP BY ALL),
c AS (SELECT chain, max(no) AS last, count(*) AS n_pages, sum(n)::bigint AS n_features, count(*) FILTER (NOT more) AS ends, arg_max(more, no) AS open_end
      FROM p GROUP BY 1)
SELECT chain, n_pages, n_features, last + 1 - n_pages AS missing_pages, 0::bigint AS repeated_pages,
       ends - CASE WHEN open_end THEN 0 ELSE 1 END AS early_ends, open_end,
       last + 1 = n_pages AND ends = 1 AND NOT open_end AS whole FROM c
""")
def json_chains(spark, sf_dir):
    """Events as a chain of pages per type: some pages of one type are lost, some pages say too early that
    no more follow."""
    from medalloy.sources.json_pages import chain_report
    e = read(spark, sf_dir, "events").withColumn("no", F.expr("event_id div 500"))
    last = e.agg(F.max("no")).scalar()
    feature = F.struct(F.struct("event_id", "user_id").alias("attributes"))
    pages = (e.where((F.col("event_type") != "view") | (F.col("no") % 5 != 2)).withColumn("more", (F.col("no") < last) & (F.col("no") % 7 != 3))
              .groupBy(F.col("event_type").alias("chain"), "no", "more").agg(F.collect_list(feature).alias("features"))
              .select("chain", "no", F.to_json(F.struct("features", F.col("more").alias("exceededTransferLimit"))).alias("page")))
    return chain_report(pages, "chain", "no", "page")


@plan("series_observations", "S11", oracle="""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS value,
       strftime(o_orderdate, '%Y-%m-%d') AS realtime_start, '9999-12-31' AS realtime_end FROM orders
""")
def series_observations(spark, sf_dir):
    """Orders as series pages of observations (a pending order has no value): text verbatim, absent as blank."""
    from medalloy.sources.json_pages import flatten_observations
    o = read(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    obs = F.struct(day.alias("date"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("value"),
                   day.alias("realtime_start"), F.lit("9999-12-31").alias("realtime_end"))
    pages = o.groupBy("o_orderpriority", F.expr("o_orderkey div 1000")).agg(F.collect_list(obs).alias("observations"))
    return flatten_observations(pages.select(F.to_json(F.struct("observations")).alias("page")), "page")


def _ledger(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("source_url"), F.col("doc_id").alias("started"),
                    F.when(F.col("n_chars") >= 100, au.SUCCEEDED).otherwise(au.FAILED).alias("status"),
                    F.sha2("text", 256).alias("file_sha256"))


@plan("latest_hash", "L6 O2", oracle="""
SELECT source AS source_url, arg_max(sha256(text), doc_id) AS last_sha256 FROM documents WHERE n_chars >= 100 GROUP BY 1
""")
def latest_hash(spark, sf_dir):
    return au.latest_hash(_ledger(spark, sf_dir))


@plan("changed_files", "S12 L6", oracle="""
WITH last AS (SELECT source, arg_max(sha256(text), doc_id) AS s FROM documents WHERE n_chars >= 100 GROUP BY 1)
SELECT d.doc_id, CASE WHEN sha256(d.text) = last.s AND d.lang <> 'es' THEN 'skipped' ELSE 'land' END AS decision
FROM documents d LEFT JOIN last ON last.source = d.source
""")
def changed_files(spark, sf_dir):
    """Every document is a candidate download; skipped only when identical to the source's
    last succeeded landing and that landed copy still exists (Spanish copies were removed)."""
    d = read(spark, sf_dir, "documents")
    cand = d.select("doc_id", F.col("source").alias("source_url"), F.sha2("text", 256).alias("file_sha256"),
                    (F.col("lang") != "es").alias("landed_exists"))
    return fs.changed_files(cand, au.latest_hash(_ledger(spark, sf_dir))).select("doc_id", "decision")


@plan("changed_landed", "S12 L6", oracle="""
WITH last AS (SELECT source, arg_max(sha256(text), doc_id) AS s, arg_max(lang, doc_id) AS lang FROM documents WHERE n_chars >= 100 GROUP BY 1)
SELECT d.doc_id, CASE WHEN sha256(d.text) = last.s AND last.lang <> 'es' THEN 'skipped' ELSE 'land' END AS decision
FROM documents d LEFT JOIN last ON last.source = d.source
""")
def changed_landed(spark, sf_dir):
    """The last landed text of each source lies as a file in a landing folder (Spanish ones were removed);
    whether a landed copy still exists is read from the folder's listing."""
    d = read(spark, sf_dir, "documents")
    last = d.where(F.col("n_chars") >= 100).groupBy("source").agg(F.max_by(F.struct("text", "lang"), "doc_id").alias("f"))
    path = fs.staging_path(spark, "landing")
    last.where("f.lang <> 'es'").select("source", F.col("f.text").alias("text")).write.partitionBy("source").option("lineSep", "\u0000").text(path)
    there = fs.landed_files(spark, path).select(F.regexp_extract("path", r"/source=([^/]+)/", 1).alias("source_url"), F.lit(True).alias("landed_exists"))
    cand = d.select("doc_id", F.col("source").alias("source_url"), F.sha2("text", 256).alias("file_sha256"))
    cand = cand.join(fs.broadcast_if_small(there.distinct()), "source_url", "left")
    return fs.changed_files(cand, au.latest_hash(_ledger(spark, sf_dir))).select("doc_id", "decision")


@plan("accept_files", "S13", oracle="""
SELECT doc_id,
       CASE WHEN octet_length(encode(text)) = 0 THEN 'empty'
            WHEN octet_length(encode(text)) <> n_chars THEN 'size_mismatch'
            WHEN lang = 'en' AND n_chars % 3 = 0 THEN 'header_mismatch'
       END AS reject_reason
FROM documents
""")
def accept_files(spark, sf_dir):
    """Acceptance checks on landed files: declared size = ``n_chars`` (so multi-byte texts fail
    the byte-size check), English files are CSV whose first columns must be ``doc_id,text``;
    every third length has ``texts`` for the second column, which has the same first characters."""
    d = read(spark, sf_dir, "documents")
    header = F.concat(F.lit(fs.BOM + "doc_id,text"), F.when(F.col("n_chars") % 3 == 0, "s").otherwise(""), F.lit(",lang\r\n"))
    reason = fs.acceptance_reason(F.encode(F.concat(header, "text"), "UTF-8"), F.octet_length("text"), F.col("n_chars"),
                                  F.when(F.col("lang") == "en", "csv").otherwise("txt"), F.lit("doc_id,text"))
    return d.select("doc_id", reason.alias("reject_reason"))


@plan("fixed_width_parse", "S15", oracle="""
WITH l AS (
  SELECT c_custkey, c_mktsegment, 'ST' || CAST(c_custkey AS VARCHAR) AS station,
         printf('%.4f', c_acctbal / 100) AS lat, printf('%.4f', -c_acctbal / 50) AS lon,
         CASE WHEN c_nationkey < 20 THEN ['AL','AK','AZ','AR','CA','CO','CT','DE','DC','FL','GA','HI','ID','IL','IN','IA','KS','KY','LA','ME'][c_nationkey + 1]
              ELSE 'ZZ' END AS state
  FROM customer)
SELECT station, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude, state
FROM l WHERE c_mktsegment <> 'BUILDING' AND state <> 'ZZ'
""")
def fixed_width_parse(spark, sf_dir):
    """Station inventory lines ``id lat lon elev state name with spaces``; short lines skipped."""
    c = read(spark, sf_dir, "customer")
    states = F.array(*[F.lit(s) for s in fs.US_STATES[:20]])
    state = F.when(F.col("c_nationkey") < 20, F.element_at(states, F.col("c_nationkey") + 1)).otherwise(F.lit("ZZ"))
    line = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("ST"), F.col("c_custkey").cast("string"))).otherwise(
        F.format_string("ST%d %.4f %.4f %d %s %s", F.col("c_custkey"), F.col("c_acctbal") / 100,
                        -F.col("c_acctbal") / 50, F.col("c_nationkey"), state, F.col("c_name")))
    return fs.parse_inventory(c.select(line.alias("value")))
