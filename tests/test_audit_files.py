import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from medalloy.operators import audit as au
from medalloy.plans import audit_plans
from medalloy.sources import files as fs

T0 = dt.datetime(2024, 1, 1)


def _status(spark, task_rows, step_rows):
    tr = spark.createDataFrame(task_rows or [("r", "x", 0, "SUCCESS", None)],
                               "run_id string, task_key string, attempt_number int, result_state string, error string")
    steps = spark.createDataFrame(step_rows, "run_id string, step_name string, status string")
    fails = au.task_outcomes(tr, exclude_tasks=["finalize"])
    runs = spark.createDataFrame([("r",)], "run_id string")
    listed = sorted((r.kind, r.name, r.error) for r in au.failure_rows(steps, fails).collect())
    return au.run_status(runs, steps, fails).first(), listed


def test_run_status_cases(spark):
    ok, listed = _status(spark, [("r", "a", 0, "SUCCESS", None)], [])
    assert ok.status == "succeeded" and ok.error_message is None and not listed
    # leaf that never logged: failure only from the task outcome
    r, listed = _status(spark, [("r", "leaf", 0, "FAILED", "\u001b[31mboom\u001b[0m")], [])
    assert r.status == "failed" and r.error_message == "failed tasks: 1, first leaf" and r.failed_steps == 0
    assert listed == [("task", "leaf", "[FAILED] boom")]
    # upstream-skipped tasks are not counted
    r, _ = _status(spark, [("r", "early", 0, "FAILED", "x"), ("r", "later", 0, "UPSTREAM_FAILED", None)], [])
    assert r.failed_tasks == 1
    # logged step + task: both sources in the message
    r, listed = _status(spark, [("r", "t", 0, "TIMEDOUT", None)], [("r", "nb_a", "failed"), ("r", "nb_a", "failed")])
    assert r.error_message == "failed steps: 1, first nb_a; tasks: 1, first t"
    assert listed == [("step", "nb_a", None), ("task", "t", "[TIMEDOUT] (no text)")]
    # two leaves
    r, listed = _status(spark, [("r", "l1", 0, "FAILED", "e1"), ("r", "l2", 0, "CANCELED", "e2")], [])
    assert r.failed_tasks == 2 and [x[1] for x in listed] == ["l1", "l2"]
    # failed then healed on retry; the finalizer itself is ignored
    r, _ = _status(spark, [("r", "t", 0, "FAILED", "e"), ("r", "t", 1, "SUCCESS", None),
                        ("r", "finalize", 0, "FAILED", "running")], [])
    assert r.status == "succeeded"


def test_run_status_names_every_failure(spark):
    runs = spark.createDataFrame([("r",), ("ok",), ("s",)], "run_id string")
    steps = spark.createDataFrame([("r", "nb_b", "failed"), ("r", "nb_a", "failed"), ("r", "nb_a", "failed"), ("r", "nb_c", "succeeded"),
                                   ("s", None, "failed")], "run_id string, step_name string, status string")
    fails = spark.createDataFrame([("r", "t2", "[FAILED] e2"), ("r", "t1", "[CANCELED] e1"), ("r", "t3", "[TIMEDOUT] e3")],
                                  "run_id string, task_key string, error string")
    got = {r.run_id: r for r in au.run_status(runs, steps, fails, listed=True).collect()}
    assert got["r"].error_message == ("2 logged step(s) failed: nb_a, nb_b. 3 task(s) failed: t1: [CANCELED] e1; t2: [FAILED] e2; "
                                      "t3: [TIMEDOUT] e3 See the step log and task matrix.")
    assert (got["r"].failed_steps, got["r"].failed_tasks) == (2, 3)
    assert (got["ok"].status, got["ok"].failed_steps, got["ok"].error_message) == ("succeeded", 0, None)
    assert (got["s"].status, got["s"].failed_steps, got["s"].error_message) == ("failed", 1, "See the step log and task matrix.")


def test_run_status_query_lists_what_failed(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 2, 5, i), 1 + i, ("error", "signup", "click")[i % 3], 99.0 if i % 4 == 0 else 1.0, '{"k": %d}' % i)
            for i in range(24)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(str(tmp_path / "events.parquet"))
    got = {r.run_id: r for r in audit_plans.run_status(spark, str(tmp_path)).collect()}
    for day in (0, 1):
        r = got[f"2024-01-0{1 + day}"]
        steps = sorted(f"step_{1 + i}" for i in range(24) if i % 2 == day and i % 4 == 0)
        tasks = sorted(f"task_{1 + i}: [{('FAILED', 'TIMEDOUT')[i % 3]}] code {i}" for i in range(24) if i % 2 == day and i % 3 < 2)
        told = [f"{len(steps)} logged step(s) failed: {', '.join(steps)}."] if steps else []
        assert r.error_message == " ".join([*told, f"{len(tasks)} task(s) failed: {'; '.join(tasks)}", "See the step log and task matrix."])
        assert (r.failed_steps, r.failed_tasks) == (len(steps), len(tasks))


def test_header_report_and_positional(spark):
    d = tempfile.mkdtemp(prefix="hdr-", dir="/tmp")
    with open(os.path.join(d, "good.csv"), "w", encoding="utf-8") as f:
        f.write("﻿date,value\n2024-01-01,1.5\n")
    with open(os.path.join(d, "bad.csv"), "w") as f:
        f.write("day,value\n2024-01-02,.\n")
    rep = {os.path.basename(r.file_path): (r.ok, list(r.missing)) for r in
           fs.header_report(spark, d, ["date", "value"]).collect()}
    assert rep == {"good.csv": (True, []), "bad.csv": (False, ["date"])}
    sub = {os.path.basename(r.file_path): r.ok for r in fs.header_report(spark, d, ["value"], mode="subset").collect()}
    assert sub == {"good.csv": True, "bad.csv": True}
    pos = fs.read_csv_positional(spark, d, ["observation_date", "value"])
    assert sorted(r.observation_date for r in pos.collect()) == ["2024-01-01", "2024-01-02"]


def test_ragged_csv_files(spark):
    d = tempfile.mkdtemp(prefix="ragged-", dir="/tmp")
    files = {
        "US1.csv": 'STATION,NAME,ANN-TAVG-NORMAL,EXTRA\nUS1,"Town, ST",55.2,x\n',
        "US2.csv": 'NAME,STATION\n"Other",US2\n',
        "CA1.csv": 'STATION,NAME,ANN-TAVG-NORMAL\nCA1,North,1.0\n',
        "US3.csv": 'STATION,ANN-TAVG-NORMAL\nUS3,\n',
    }
    for n, c in files.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(c)
    out = fs.ragged_csv(spark, d, ["STATION", "NAME", "ANN-TAVG-NORMAL"], id_col="STATION", keep_prefix="US")
    got = sorted((r.STATION, r.NAME, r["ANN-TAVG-NORMAL"]) for r in out.collect())
    assert got == [("US1", "Town, ST", "55.2"), ("US2", "Other", None), ("US3", None, None)]


def test_inventory_and_acceptance(spark):
    lines = spark.createDataFrame([("USW1 40.1 -75.2 10.0 PA Some Name Here",), ("SHORT 1 2",),
                                   ("CAX1 50.0 -100.0 1.0 ON Far",)], "value string")
    got = [tuple(r) for r in fs.parse_inventory(lines).collect()]
    assert got == [("USW1", 40.1, -75.2, "PA")]
    df = spark.createDataFrame([(b"",), (b"a,b\n1,2",), (b"\xef\xbb\xbfa,b,c\n1",), (b"x,y\n",)], "content binary")
    r = df.select(fs.acceptance_reason(F.col("content"), F.length("content"), F.lit(None).cast("long"),
                                       F.lit("csv"), F.lit("a,b")).alias("r")).collect()
    assert [x.r for x in r] == ["empty", None, None, "header_mismatch"]
    df = spark.createDataFrame([(b"a,bb\r\n1",), (b"a,b\r\n1",), (b"a",)], "content binary")  # whole columns, not characters
    r = df.select(fs.acceptance_reason(F.col("content"), F.length("content"), F.lit(None).cast("long"),
                                       F.lit("csv"), F.lit("a,b")).alias("r")).collect()
    assert [x.r for x in r] == ["header_mismatch", None, "header_mismatch"]


def test_audit_log_steps(spark):
    from medalloy.store import TableStore
    st = TableStore(spark, tempfile.mkdtemp(prefix="audit-", dir="/tmp"))
    log = au.AuditLog(st)
    with log.step("s1", "r1", "load_a") as s:
        s.rows_read, s.rows_written = 10, 9
    try:
        with log.step("s2", "r1", "load_b"):
            raise RuntimeError("boom")
    except RuntimeError:
        pass
    with log.step("s3", "r1", "load_c") as s:
        s.no_files()
    got = {r.step_log_id: (r.status, r.rows_written) for r in log.state().collect()}
    assert got == {"s1": ("succeeded", 9), "s2": ("failed", None), "s3": ("no_files", None)}
    bad = au.AuditLog(TableStore(spark, "/proc/definitely/not/writable"))
    assert bad.event("x", "r", "n", "running")["ok"] is False


def test_enforce_headers(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="hdr2-", dir="/tmp")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("x,y\n1,2\n")
    assert fs.enforce_headers(fs.header_report(spark, d, ["x", "y"])) == "ok"
    with pytest.raises(fs.HeaderContractError):
        fs.enforce_headers(fs.header_report(spark, d, ["x", "z"]))
    assert fs.enforce_headers(fs.header_report(spark, d, ["x", "y"]).limit(0)) == "no_files"


def test_run_without_header_raises(spark):
    import pytest
    runs = spark.createDataFrame([("r1",), ("r1",)], "run_id string")
    fails = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r2", "c")], "run_id string, task string")
    assert [tuple(r) for r in au.runs_without_header(runs, fails).collect()] == [("r2", 2)]
    with pytest.raises(au.MissingRunHeader, match="1 runs"):
        au.require_headers(runs, fails)
    au.require_headers(runs, fails.where("run_id = 'r1'"))


def test_title_and_key_edges(spark):
    from medalloy.functions.text import county_key, title_parts
    df = spark.createDataFrame([("New York-Newark, NY-NJ",), ("Lone",), ("A, B, TX",), ("",), (None,)], "t string")
    p = title_parts(F.col("t"))
    got = [(r.c, r.s, r.p) for r in df.select(p["cities"].alias("c"), p["states"].alias("s"), p["primary_state"].alias("p")).collect()]
    assert got == [(["New York", "Newark"], ["NY", "NJ"], "NY"), (["Lone"], [], ""), (["A, B"], ["TX"], "TX"), ([], [], ""),
                   (None, None, None)]
    keys = spark.createDataFrame([("1", "7"), ("36", "061"), ("4", "12345")], "s string, c string")
    assert [r[0] for r in keys.select(county_key(F.col("s"), F.col("c"))).collect()] == ["01007", "36061", "0412345"]
