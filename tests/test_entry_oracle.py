"""Driver contract: entry smoke + every plan against its DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from medalloy.plans.tables import TABLES
from test_plan_shape import assert_scalable_shape

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["date_key", "month_end"] and df.count() > 0


def test_every_plan_has_ops_and_runs_or_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_plan_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    assert_scalable_shape(df)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _canon(cols, cur.fetchall())
