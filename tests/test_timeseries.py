import datetime as dt
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medalloy.operators import timeseries as ts
from medalloy.sources.calendar import calendar

D = dt.date


def test_calendar_counts(spark):
    cal = calendar(spark, "1947-01-01", "2031-12-31")
    r = cal.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_month_end").cast("int")).alias("me"),
                F.sum(F.col("is_quarter_end").cast("int")).alias("qe")).first()
    assert (r.n, r.me, r.qe) == (31046, 1020, 340)


def _months(lo, n):
    out, y, m = [], lo.year, lo.month
    for _ in range(n):
        nxt = D(y + (m == 12), m % 12 + 1, 1)
        out.append(nxt - dt.timedelta(days=1))
        y, m = nxt.year, nxt.month
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 11), st.one_of(st.none(), st.floats(-5, 5))),
                max_size=15, unique_by=lambda t: (t[0], t[1])))
def test_asof_matches_brute_force(spark, obs):
    months = _months(D(2024, 1, 1), 12)
    spine = spark.createDataFrame([(k, m) for k in range(3) for m in months], "k int, d date")
    o = spark.createDataFrame([(k, months[i], v) for k, i, v in obs], "k int, d date, v double")
    got = {(r.k, r.d): r.v for r in ts.asof_fill(spine, o, "k", spine_date="d", obs_date="d", values="v").collect()}
    for k in range(3):
        for m in months:
            prior = sorted((months[i], v) for kk, i, v in obs if kk == k and months[i] <= m)
            want = prior[-1][1] if prior else None  # latest observation wins even when NULL
            assert got[(k, m)] == want


def test_asof_skip_nulls(spark):
    spine = spark.createDataFrame([(1, D(2024, 1, 31)), (1, D(2024, 2, 29)), (1, D(2024, 3, 31))], "k int, d date")
    o = spark.createDataFrame([(1, D(2024, 1, 31), 1.0), (1, D(2024, 2, 29), None)], "k int, d date, v double")
    keep = sorted(ts.asof_fill(spine, o, "k", spine_date="d", obs_date="d", values="v").collect())
    skip = sorted(ts.asof_fill(spine, o, "k", spine_date="d", obs_date="d", values="v", skip_nulls=True).collect())
    assert [r.v for r in keep] == [1.0, None, None]
    assert [r.v for r in skip] == [1.0, 1.0, 1.0]


def test_period_change_null_across_gap(spark):
    rows = [(1, D(2023, 3, 31), 100.0), (1, D(2024, 3, 31), 110.0), (1, D(2024, 6, 30), 50.0), (1, D(2023, 9, 30), 0.0),
            (1, D(2024, 9, 30), 5.0)]
    df = spark.createDataFrame(rows, "k int, d date, v double")
    got = {r.d: r.pct_change_yoy for r in ts.period_change(df, "k", "d", "v").collect()}
    assert got[D(2024, 3, 31)] == 10.0
    assert got[D(2024, 6, 30)] is None      # prior-year quarter missing
    assert got[D(2024, 9, 30)] is None      # zero base


def test_latest_per_key_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "z"), (2, 1, "q")], "k int, t int, x string")
    got = sorted(tuple(r) for r in ts.latest_per_key(df, "k", ["t", "x"]).collect())
    assert got == [(1, 5, "b"), (2, 1, "q")]


def test_native_gaps_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for s in ("a", "b"):
        d = D(2020, 1, 1)
        for _ in range(60):
            d += dt.timedelta(days=rnd.choice([7, 7, 7, 14, 8, 21]))
            rows.append((s, d))
    df = spark.createDataFrame(rows, "s string, d date")
    got = {r.s: (r.n, r.modal_days, r.missing) for r in ts.native_gaps(df, "s", "d").collect()}
    pdf = pd.DataFrame(rows, columns=["s", "d"])
    for s, g in pdf.groupby("s"):
        ds = sorted(set(g.d))
        gaps = [(b - a).days for a, b in zip(ds, ds[1:])]
        cnt = pd.Series(gaps).value_counts()
        modal = min(k for k, v in cnt.items() if v == cnt.max())
        missing = sum(int(round(x / modal + 1e-12)) - 1 for x in gaps if x > modal * 1.5)
        assert got[s] == (len(ds), modal, missing)
