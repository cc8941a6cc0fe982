"""Audit plans over ``events`` read as a job's task attempts.

run = calendar day of the event, task = ``task_<user_id>``, attempt order = (ts, event_id),
state from the event type (fixed mapping below); events with value > 95 are also logged
steps that failed. ``task_0`` plays the finalizer and is never counted.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.operators import audit as au
from medalloy.operators import upsert as up
from medalloy.plans.registry import plan
from medalloy.plans.tables import read

# Event type → task result state.
STATE_OF = {"error": "FAILED", "signup": "TIMEDOUT", "view": "UPSTREAM_FAILED",
            "click": "SUCCESS", "purchase": "SUCCESS"}
_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_OF.items()) + " END"


def task_runs(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    state = F.create_map(*[F.lit(x) for kv in STATE_OF.items() for x in kv])[F.col("event_type")]
    return e.select(
        F.to_date("ts").cast("string").alias("run_id"),
        F.concat(F.lit("task_"), F.col("user_id").cast("string")).alias("task_key"),
        "ts", "event_id", state.alias("result_state"),
        F.concat(F.lit("\u001b[31mcode "), F.get_json_object("props", "$.k"), F.lit("\u001b[0m")).alias("error"),
        "value")


_D_TR = f"""
tr AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, 'task_' || CAST(user_id AS VARCHAR) AS task_key,
              ts, event_id, {_CASE} AS result_state,
              'code ' || json_extract_string(props, '$.k') AS error, value FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, task_key ORDER BY ts DESC, event_id DESC) AS rn FROM tr) WHERE rn = 1),
fails AS (SELECT run_id, task_key, '[' || result_state || '] ' || error AS error FROM latest
          WHERE result_state IN ('FAILED', 'TIMEDOUT', 'CANCELED', 'MAXIMUM_CONCURRENT_RUNS_REACHED') AND task_key <> 'task_0')
"""


@plan("latest_attempt", "N6 L5", oracle=f"""
WITH {_D_TR}
SELECT run_id, task_key, error FROM fails
""")
def latest_attempt(spark, sf_dir):
    """Failed task outcomes: latest attempt per task only (a healed retry is not a failure)."""
    return au.task_outcomes(task_runs(spark, sf_dir), attempt_cols=["ts", "event_id"], exclude_tasks=["task_0"])


@plan("run_status", "L4 L5 A12", oracle=f"""
WITH {_D_TR},
steps AS (SELECT DISTINCT run_id, 'step_' || CAST(user_id AS VARCHAR) AS step_name FROM
            (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, user_id FROM events WHERE value > 95)),
fs AS (SELECT run_id, count(*) AS failed_steps, string_agg(step_name, ', ' ORDER BY step_name) AS names FROM steps GROUP BY 1),
ft AS (SELECT run_id, count(*) AS failed_tasks, string_agg(task_key || ': ' || error, '; ' ORDER BY task_key || ': ' || error) AS msgs
       FROM fails GROUP BY 1),
runs AS (SELECT DISTINCT run_id FROM tr)
SELECT r.run_id,
       CASE WHEN coalesce(fs.failed_steps, 0) > 0 OR coalesce(ft.failed_tasks, 0) > 0 THEN 'failed' ELSE 'succeeded' END AS status,
       coalesce(fs.failed_steps, 0) AS failed_steps, coalesce(ft.failed_tasks, 0) AS failed_tasks,
       CASE WHEN coalesce(fs.failed_steps, 0) > 0 OR coalesce(ft.failed_tasks, 0) > 0 THEN
         concat_ws(' ',
           CASE WHEN fs.failed_steps > 0 THEN CAST(fs.failed_steps AS VARCHAR) || ' logged step(s) failed: ' || fs.names || '.' END,
           CASE WHEN ft.failed_tasks > 0 THEN CAST(ft.failed_tasks AS VARCHAR) || ' task(s) failed: ' || ft.msgs END,
           'See the step log and task matrix.') END AS error_message
FROM runs r LEFT JOIN fs ON fs.run_id = r.run_id LEFT JOIN ft ON ft.run_id = r.run_id
""")
def run_status(spark, sf_dir):
    """Status of every run, with a message that names every failed step and every failed task with its error."""
    tr = task_runs(spark, sf_dir)
    fails = au.task_outcomes(tr, attempt_cols=["ts", "event_id"], exclude_tasks=["task_0"])
    return au.run_status(tr, _failed_steps(spark, sf_dir), fails, listed=True)


def _failed_steps(spark, sf_dir):
    return (read(spark, sf_dir, "events").where(F.col("value") > 95)
            .select(F.to_date("ts").cast("string").alias("run_id"),
                    F.concat(F.lit("step_"), F.col("user_id").cast("string")).alias("step_name"),
                    F.lit(au.FAILED).alias("status")))


@plan("run_failures", "A12 L4 L5", oracle=f"""
WITH {_D_TR}
SELECT run_id, 'task' AS kind, task_key AS name, error FROM fails
UNION ALL
SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR), 'step', 'step_' || CAST(user_id AS VARCHAR), CAST(NULL AS VARCHAR) FROM events WHERE value > 95
""")
def run_failures(spark, sf_dir):
    """Every failed step name and task of every run, as rows."""
    fails = au.task_outcomes(task_runs(spark, sf_dir), attempt_cols=["ts", "event_id"], exclude_tasks=["task_0"])
    return au.failure_rows(_failed_steps(spark, sf_dir), fails)


@plan("step_state", "L1", oracle="""
WITH s AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, 'step_' || CAST(user_id AS VARCHAR) AS step_log_id,
                  ts, event_id, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'running'
                                     WHEN event_type = 'signup' THEN 'no_files' ELSE 'succeeded' END AS status, value FROM events),
l AS (SELECT *, row_number() OVER (PARTITION BY run_id, step_log_id ORDER BY ts DESC, event_id DESC) AS rn,
             min(ts) OVER (PARTITION BY run_id, step_log_id) AS started,
             count(*) OVER (PARTITION BY run_id, step_log_id) AS events FROM s)
SELECT run_id, step_log_id, status, events,
       round(date_diff('microsecond', started, ts) / 1000000.0, 3) AS duration_seconds
FROM l WHERE rn = 1
""")
def step_state(spark, sf_dir):
    """Step log as appended events; current state = latest event per (run, step), with the
    step's duration from its first event."""
    e = read(spark, sf_dir, "events")
    s = e.select(F.to_date("ts").cast("string").alias("run_id"),
                 F.concat(F.lit("step_"), F.col("user_id").cast("string")).alias("step_log_id"), "ts", "event_id",
                 F.when(F.col("event_type") == "error", au.FAILED).when(F.col("event_type") == "view", au.RUNNING)
                  .when(F.col("event_type") == "signup", au.NO_FILES).otherwise(au.SUCCEEDED).alias("status"))
    cur = au.current_state(s, ["run_id", "step_log_id"], "ts", ["event_id"])
    agg = s.groupBy("run_id", "step_log_id").agg(F.min("ts").alias("started"), F.count(F.lit(1)).alias("events"))
    j = cur.join(agg, ["run_id", "step_log_id"])
    return j.select("run_id", "step_log_id", "status", "events",
                    F.round(au.duration_seconds(F.col("started"), F.col("ts")), 3).alias("duration_seconds"))


@plan("stuck_steps", "L7", oracle="""
WITH s AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, 'step_' || CAST(user_id AS VARCHAR) AS step_log_id,
                  ts, event_id, CASE WHEN event_type = 'view' THEN 'running' ELSE 'succeeded' END AS status FROM events),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, step_log_id ORDER BY ts DESC, event_id DESC) rn FROM s) WHERE rn = 1),
runs AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id FROM events GROUP BY 1
         HAVING max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1)
SELECT l.run_id, l.step_log_id FROM l WHERE l.status = 'running' AND l.run_id IN (SELECT run_id FROM runs)
""")
def stuck_steps(spark, sf_dir):
    """Steps still ``running`` in runs that closed (a run closes once it saw a purchase)."""
    e = read(spark, sf_dir, "events")
    s = e.select(F.to_date("ts").cast("string").alias("run_id"),
                 F.concat(F.lit("step_"), F.col("user_id").cast("string")).alias("step_log_id"), "ts", "event_id",
                 F.when(F.col("event_type") == "view", au.RUNNING).otherwise(au.SUCCEEDED).alias("status"))
    cur = au.current_state(s, ["run_id", "step_log_id"], "ts", ["event_id"])
    runs = (e.groupBy(F.to_date("ts").cast("string").alias("run_id"))
             .agg(F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("closed"))
             .select("run_id", F.when(F.col("closed") == 1, au.SUCCEEDED).otherwise(au.RUNNING).alias("run_status")))
    return au.stuck_steps(cur, runs).select("run_id", "step_log_id")


@plan("outcome_summary", "L8", oracle=f"""
SELECT {_CASE} AS status, count(*) AS n FROM events GROUP BY 1
""")
def outcome_summary(spark, sf_dir):
    return au.outcome_summary(task_runs(spark, sf_dir).withColumnRenamed("result_state", "status"))


@plan("download_gap", "J13", oracle="""
SELECT 'landing/' || source || '/' || CAST(doc_id AS VARCHAR) AS landed_file_path, source
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def download_gap(spark, sf_dir):
    """Landed files (documents) without an ingestion row (labels)."""
    d = read(spark, sf_dir, "documents").select(
        F.concat(F.lit("landing/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("landed_file_path"),
        "source")
    lb = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").select(
        F.concat(F.lit("landing/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("source_file_path"))
    return au.landed_not_ingested(d, lb)


@plan("file_log", "L2", oracle="""
SELECT 'run_1' AS run_id, 'ingest_' || source AS step_log_id, source AS source_system, 'bronze.documents' AS target_table,
       'landing/' || source || '/' || lang AS source_file_path, count(*) AS rows_ingested,
       sha256('run_1|ingest_' || source || '|landing/' || source || '/' || lang) AS file_log_id
FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source, lang
""")
def file_log(spark, sf_dir):
    """One row per file a load read: documents as rows of one file per source and language."""
    d = read(spark, sf_dir, "documents").withColumn("source_file_path", F.concat(F.lit("landing/"), "source", F.lit("/"), "lang"))
    return au.file_rows(d, run_id=F.lit("run_1"), step_log_id=F.concat(F.lit("ingest_"), "source"), source_system=F.col("source"),
                        target_table="bronze.documents")


@plan("landing_log", "L2", oracle="""
SELECT user_id AS source_url, arg_max(h, (ts, event_id)) AS file_sha256,
       CASE WHEN arg_max(event_type, (ts, event_id)) = 'view' THEN 'skipped'
            WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'failed' ELSE 'succeeded' END AS status
FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, ts, event_id, event_type,
             CASE WHEN event_type = 'error' THEN '' ELSE sha256(props) END AS h FROM events) GROUP BY user_id
""")
def landing_log(spark, sf_dir):
    """Latest download per source: events as attempts, views as unchanged files, errors without a file."""
    e = read(spark, sf_dir, "events")
    a = e.select(F.col("user_id").cast("string").alias("source_url"), "ts", "event_id",
                 F.when(F.col("event_type") != "error", F.sha2("props", 256)).alias("file_sha256"),
                 F.when(F.col("event_type") == "view", "skipped").otherwise("land").alias("decision"))
    return au.landing_rows(a, order=["ts", "event_id"]).withColumn("file_sha256", F.coalesce("file_sha256", F.lit("")))


@plan("transform_log", "L3 W5", oracle="""
WITH t AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b AS (SELECT o_custkey AS k, o_totalprice >= 5000 AS good FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
s AS (SELECT DISTINCT k FROM b WHERE good)
SELECT sha256('run_1|silver|silver.customer_last') AS transform_log_id, 'run_1' AS run_id, 'silver' AS step_log_id,
       'orders' AS source_system, 'silver.customer_last' AS target_table, 'upsert' AS load_type,
       (SELECT count(*) FROM b) AS rows_read, (SELECT count(*) FROM b WHERE NOT good) AS rows_rejected,
       (SELECT count(*) FROM b WHERE good) - (SELECT count(*) FROM s) AS rows_deduplicated,
       (SELECT count(*) FROM s WHERE k NOT IN (SELECT k FROM t)) AS rows_inserted,
       (SELECT count(*) FROM s WHERE k IN (SELECT k FROM t)) AS rows_updated, CAST(0 AS BIGINT) AS rows_unchanged,
       (SELECT count(*) FROM t WHERE k NOT IN (SELECT k FROM s)) AS rows_kept,
       (SELECT count(*) FROM (SELECT k FROM t UNION SELECT k FROM s)) AS rows_written, 'succeeded' AS status, '' AS error,
       (SELECT min(o_orderdate) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS started,
       (SELECT max(o_orderdate) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS ended,
       (SELECT epoch(max(o_orderdate)) - epoch(min(o_orderdate)) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS duration_seconds,
       'orders of 5000 or more; last order of a customer' AS rules_applied
""")
def transform_log(spark, sf_dir):
    """The log row of an upsert of each customer's last order: history before 1998, batch from 1998, small orders rejected."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    cut = F.lit("1998-01-01").cast("timestamp")
    batch = o.where(F.col("o_orderdate") >= cut)
    good = F.col("o_totalprice") >= 5000
    target = up.dedupe(o.where(F.col("o_orderdate") < cut), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    merged = up.merge_upsert(target, batch.where(good), ["o_custkey"], order=["o_orderdate", "o_orderkey"])
    rejected = batch.agg(F.coalesce(F.sum((~good).cast("long")), F.lit(0))).scalar()
    row = au.transform_rows(merged, run_id="run_1", step_log_id="silver", source_system="orders",
                            target_table="silver.customer_last", load_type="upsert", rows_rejected=rejected,
                            started=batch.agg(F.min("o_orderdate")).scalar(), ended=batch.agg(F.max("o_orderdate")).scalar(),
                            rules=["orders of 5000 or more", "last order of a customer"])
    return row.withColumns({"error": F.coalesce("error", F.lit("")), **{c: F.col(c).cast("timestamp_ntz") for c in ("started", "ended")}})


@plan("run_header_check", "L4", oracle="""
WITH r AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || CAST(user_id AS VARCHAR) AS run_id, event_type FROM events)
SELECT run_id, count(*) AS failures FROM r
WHERE event_type = 'error' AND run_id NOT IN (SELECT run_id FROM r WHERE event_type = 'click') GROUP BY run_id
""")
def run_header_check(spark, sf_dir):
    """Runs (user-days) that logged failures without a header; a click is the header row."""
    e = read(spark, sf_dir, "events").select(
        F.concat_ws("/", F.to_date("ts").cast("string"), F.col("user_id").cast("string")).alias("run_id"), "event_type")
    return au.runs_without_header(e.where("event_type = 'click'"), e.where("event_type = 'error'"))
