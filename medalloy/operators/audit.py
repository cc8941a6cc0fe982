"""Append-only audit trail and run-status queries.

Audit rows are appended as events; "current state" is derived by aggregation
(latest event per id), never by in-place updates. Run status combines two sources:
failed logged steps and failed task outcomes (latest attempt per task only).
Message lists are built from *distinct* task / step names per run, so their length
is bounded by the job's task catalogue, not by data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.functions.text import strip_ansi
from medalloy.operators.timeseries import latest_per_key

SUCCEEDED, FAILED, RUNNING, NO_FILES, SKIPPED = "succeeded", "failed", "running", "no_files", "skipped"

# Terminal task states that count as a real failure of the run. Upstream-
# derived states, success, exclusion and disabling are deliberately not in this set.
FAILURE_STATES = ("FAILED", "TIMEDOUT", "CANCELED", "MAXIMUM_CONCURRENT_RUNS_REACHED")


def current_state(events: DataFrame, id_cols: str | Sequence[str], ts_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """L1 — latest event per id (a step opened ``running`` and closed ``succeeded`` /
    ``no_files`` / ``failed`` is two appended rows; the later one is its state)."""
    return latest_per_key(events, id_cols, [ts_col, *tiebreak])


def duration_seconds(started: Column, ended: Column) -> Column:
    """Seconds between two timestamps; NULL if either end is missing."""
    s, e = started.cast("timestamp"), ended.cast("timestamp")
    return F.when(s.isNotNull() & e.isNotNull(), (F.unix_micros(e) - F.unix_micros(s)) / F.lit(1_000_000.0))


def task_outcomes(task_runs: DataFrame, *, run_col: str = "run_id", task_col: str = "task_key",
                  attempt_cols: Sequence[str] = ("attempt_number",), state_col: str = "result_state",
                  error_col: str = "error", exclude_tasks: Sequence[str] = ()) -> DataFrame:
    """L5/N6 — latest attempt per (run, task); keep failures in :data:`FAILURE_STATES`,
    excluding named tasks (the finalizer itself); error text = ``[STATE] message``."""
    latest = latest_per_key(task_runs, [run_col, task_col], list(attempt_cols), columns=[state_col, error_col])
    failed = latest.where(F.col(state_col).isin(*FAILURE_STATES))
    if exclude_tasks:
        failed = failed.where(~F.col(task_col).isin(*exclude_tasks))
    msg = F.concat(F.lit("["), F.col(state_col), F.lit("] "),
                   strip_ansi(F.coalesce(F.col(error_col), F.lit("(no text)"))))
    return failed.select(run_col, task_col, msg.alias("error"))


def failure_rows(steps: DataFrame, failures: DataFrame, *, run_col: str = "run_id", step_name: str = "step_name",
                 step_status: str = "status", task_col: str = "task_key") -> DataFrame:
    """A12 — what failed in each run, one row per distinct step name and per task: (run, kind, name, error)."""
    step = steps.where(F.col(step_status) == FAILED).select(run_col, F.lit("step").alias("kind"), F.col(step_name).alias("name"),
                                                            F.lit(None).cast("string").alias("error")).distinct()
    return step.unionByName(failures.select(run_col, F.lit("task").alias("kind"), F.col(task_col).alias("name"), "error"))


def run_status(runs: DataFrame, steps: DataFrame, failures: DataFrame, *, run_col: str = "run_id",
               step_name: str = "step_name", step_status: str = "status", task_col: str = "task_key",
               listed: bool = False) -> DataFrame:
    """L4 — one row per run header: ``failed`` if any logged step or task outcome failed, with a message that
    gives both numbers and the first name of each; else ``succeeded``. ``listed``: the message names every failed
    step and every failed task with its error, each sorted (one string per run, as long as what failed in it)."""
    rows = failure_rows(steps, failures, run_col=run_col, step_name=step_name, step_status=step_status, task_col=task_col)
    text = {"step": ("name", ", "), "task": ("concat(name, ': ', error)", "; ")}

    def of(kind: str) -> list[Column]:
        mine, (what, sep) = F.col("kind") == kind, text[kind]
        told = (F.expr(f"listagg({what}, '{sep}') within group (order by {what}) filter (where kind = '{kind}')") if listed
                else F.min(F.when(mine, F.col("name"))))
        return [F.sum(mine.cast("long")).alias(f"n_{kind}"), told.alias(f"told_{kind}")]

    j = runs.select(run_col).distinct().join(rows.groupBy(run_col).agg(*of("step"), *of("task")), run_col, "left")
    n_s, n_t = F.coalesce("n_step", F.lit(0)), F.coalesce("n_task", F.lit(0))
    failed = (n_s > 0) | (n_t > 0)
    if listed:
        message = F.concat_ws(" ",
                              F.when(n_s > 0, F.concat(n_s.cast("string"), F.lit(" logged step(s) failed: "), F.col("told_step"), F.lit("."))),
                              F.when(n_t > 0, F.concat(n_t.cast("string"), F.lit(" task(s) failed: "), F.col("told_task"))),
                              F.lit("See the step log and task matrix."))
    else:
        parts = [F.when(n > 0, F.concat(F.lit(f"{kind}s: "), n.cast("string"), F.lit(", first "), F.col(f"told_{kind}")))
                 for kind, n in (("step", n_s), ("task", n_t))]
        message = F.concat(F.lit("failed "), F.concat_ws("; ", *parts))
    return j.select(run_col, F.when(failed, F.lit(FAILED)).otherwise(F.lit(SUCCEEDED)).alias("status"),
                    n_s.alias("failed_steps"), n_t.alias("failed_tasks"), F.when(failed, message).alias("error_message"))


def stuck_steps(steps_state: DataFrame, runs_state: DataFrame, *, run_col: str = "run_id",
                status_col: str = "status", run_status_col: str = "run_status") -> DataFrame:
    """L7 — steps whose current state is still ``running`` after their run closed."""
    closed = runs_state.where(F.col(run_status_col).isin(SUCCEEDED, FAILED)).select(run_col)
    return steps_state.where(F.col(status_col) == RUNNING).join(closed, run_col, "left_semi")


def outcome_summary(outcomes: DataFrame, status_col: str = "status") -> DataFrame:
    """L8 — counts by status."""
    return outcomes.groupBy(status_col).agg(F.count(F.lit(1)).alias("n"))


def landed_not_ingested(download_log: DataFrame, ingestion_log: DataFrame, *,
                        landed_col: str = "landed_file_path", ingested_col: str = "source_file_path") -> DataFrame:
    """J13 — landed files with no ingestion row."""
    ing = ingestion_log.select(F.col(ingested_col).alias(landed_col)).distinct()
    return download_log.join(ing, landed_col, "left_anti")


def latest_hash(ledger: DataFrame, *, source_col: str = "source_url", sha_col: str = "file_sha256",
                started_col: str = "started", status_col: str = "status") -> DataFrame:
    """L6 — newest non-null hash of a succeeded landing per source (all sources at once)."""
    ok = ledger.where((F.col(status_col) == SUCCEEDED) & F.col(sha_col).isNotNull())
    return ok.groupBy(source_col).agg(F.max_by(sha_col, started_col).alias("last_sha256"))


# --------------------------------------------------------------------------- L2, L3, run headers


def _row_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def file_rows(loaded: DataFrame, *, run_id: Column, step_log_id: Column, source_system: Column, target_table: str,
              path_col: str = "source_file_path") -> DataFrame:
    """L2 — one row per distinct source file of a load, with the rows it gave; rows without a path take no part."""
    named = loaded.where(F.col(path_col).isNotNull()).select(
        run_id.alias("run_id"), step_log_id.alias("step_log_id"), source_system.alias("source_system"),
        F.lit(target_table).alias("target_table"), F.col(path_col).alias("source_file_path"))
    rows = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("rows_ingested"))
    return rows.withColumn("file_log_id", _row_id(F.col("run_id"), F.col("step_log_id"), F.col("source_file_path")))


def landing_rows(attempts: DataFrame, *, source_col: str = "source_url", sha_col: str = "file_sha256",
                 decision_col: str = "decision", order: Sequence[str] = ("started",)) -> DataFrame:
    """L2 — one row per download: its latest attempt, as ``succeeded`` if landed and ``skipped`` if unchanged."""
    last = latest_per_key(attempts, [source_col], list(order), columns=[sha_col, decision_col])
    status = F.when(F.col(decision_col) == "skipped", SKIPPED).when(F.col(sha_col).isNull(), FAILED).otherwise(SUCCEEDED)
    return last.select(source_col, sha_col, status.alias("status"))


def transform_rows(merged: DataFrame, *, run_id: str, step_log_id: str, source_system: str, target_table: str, load_type: str,
                   rows_rejected: Column, error: str | None = None, started: Column | None = None, ended: Column | None = None,
                   rules: Sequence[str] = ()) -> DataFrame:
    """L3 — one row of a keyed load, counted in one pass over :func:`medalloy.operators.upsert.merge_upsert`'s result.

    ``rows_rejected`` is a scalar (quarantined before the merge); ``rows_read`` counts them too. ``started``
    and ``ended`` are the load's times (null if not given), ``rules`` names what was applied, in order.
    """
    def n(kind: str) -> Column:
        return F.coalesce(F.sum((F.col("_change") == kind).cast("long")), F.lit(0))

    given = F.coalesce(F.sum("_src_rows"), F.lit(0))
    c = merged.agg(given.alias("_given"), n("insert").alias("rows_inserted"), n("update").alias("rows_updated"),
                   n("unchanged").alias("rows_unchanged"), n("kept").alias("rows_kept"), F.count(F.lit(1)).alias("rows_written"))
    used = F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_unchanged")
    c = c.withColumn("rows_rejected", rows_rejected)
    begun, closed = ((F.lit(None) if t is None else t).cast("timestamp") for t in (started, ended))
    return c.select(
        _row_id(F.lit(run_id), F.lit(step_log_id), F.lit(target_table)).alias("transform_log_id"),
        F.lit(run_id).alias("run_id"), F.lit(step_log_id).alias("step_log_id"), F.lit(source_system).alias("source_system"),
        F.lit(target_table).alias("target_table"), F.lit(load_type).alias("load_type"),
        (F.col("_given") + F.col("rows_rejected")).alias("rows_read"), "rows_rejected",
        (F.col("_given") - used).alias("rows_deduplicated"), "rows_inserted", "rows_updated", "rows_unchanged", "rows_kept",
        "rows_written", F.lit(FAILED if error else SUCCEEDED).alias("status"), F.lit(error).cast("string").alias("error"),
        begun.alias("started"), closed.alias("ended"), duration_seconds(begun, closed).alias("duration_seconds"),
        F.lit("; ".join(rules)).alias("rules_applied"))


class MissingRunHeader(ValueError):
    pass


def runs_without_header(runs: DataFrame, failures: DataFrame, run_col: str = "run_id") -> DataFrame:
    """L4 — runs that logged failures but have no header row, with the number of failures."""
    logged = failures.groupBy(run_col).agg(F.count(F.lit(1)).alias("failures"))
    return logged.join(runs.select(run_col).distinct(), run_col, "left_anti")


def require_headers(runs: DataFrame, failures: DataFrame, run_col: str = "run_id") -> None:
    """L4 — raise if a run with failures has no header, with the number of such runs and the first."""
    bad = runs_without_header(runs, failures, run_col).agg(F.count(F.lit(1)).alias("n"), F.min(run_col).alias("first")).first()
    if bad.n:
        raise MissingRunHeader(f"{bad.n} runs have no header, first {bad.first}")


# --------------------------------------------------------------------------- recorder (L1–L3)


class AuditLog:
    """Append-only audit trail in a :class:`medalloy.store.TableStore`.

    ``step(...)`` is a context manager that appends a ``running`` event on entry and a
    ``succeeded`` / ``no_files`` / ``failed`` event (rows, duration, error) on exit; the
    step's state is the latest event (:func:`current_state`). Writing an audit row never
    fails the load: errors are returned in the result dict instead (L2/L3 contract).
    """

    STEP_SCHEMA = ("step_log_id string, run_id string, step_name string, status string, "
                   "rows_read long, rows_written long, event_ts timestamp, error string")

    def __init__(self, store, table: str = "pipeline_step_log"):
        self.store = store
        self.table = table

    def _append(self, rows: list[tuple], schema: str, table: str, batch: str) -> dict:
        try:
            df = self.store.spark.createDataFrame(rows, schema)
            return {"ok": True, **self.store.append(table, df, batch=batch)}
        except Exception as e:  # noqa: BLE001 - logging must not fail the load
            return {"ok": False, "error": f"{type(e).__name__}: {e}"}

    def event(self, step_log_id: str, run_id: str, step_name: str, status: str, *, rows_read=None,
              rows_written=None, error: str | None = None) -> dict:
        import datetime as _dt
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        return self._append([(step_log_id, run_id, step_name, status, rows_read, rows_written, ts, error)],
                            self.STEP_SCHEMA, self.table, batch=f"{step_log_id} {status} {ts.isoformat()}")

    def step(self, step_log_id: str, run_id: str, step_name: str):
        log = self

        class _Step:
            rows_read = None
            rows_written = None
            status = None

            def no_files(self):
                self.status = NO_FILES

            def __enter__(self):
                log.event(step_log_id, run_id, step_name, RUNNING)
                return self

            def __exit__(self, exc_type, exc, tb):
                if exc is not None:
                    log.event(step_log_id, run_id, step_name, FAILED, rows_read=self.rows_read,
                              rows_written=self.rows_written, error=f"{exc_type.__name__}: {exc}")
                    return False
                log.event(step_log_id, run_id, step_name, self.status or SUCCEEDED,
                          rows_read=self.rows_read, rows_written=self.rows_written)
                return False

        return _Step()

    def state(self) -> DataFrame:
        """Current state per step, with duration from its first event."""
        ev = self.store.read(self.table)
        cur = current_state(ev, "step_log_id", "event_ts", ["status"])
        first = ev.groupBy("step_log_id").agg(F.min("event_ts").alias("started"))
        return cur.join(first, "step_log_id").withColumn(
            "duration_seconds", duration_seconds(F.col("started"), F.col("event_ts")))
