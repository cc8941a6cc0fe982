import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medalloy.functions import (cast_error, month_end_from_yyyymm, normalise_name, quarter_end, row_hash,
                                sentinel_number, strict_double, strict_long, strip_ansi)


def test_strict_casts(spark):
    rows = [("1d",), (" 12 ",), ("NaN",), ("1e400",), (".",), ("",), (None,), ("529900.0",), ("-3.5e2",)]
    df = spark.createDataFrame(rows, "s string")
    got = df.select(strict_double("s").alias("d"), strict_long("s").alias("l"),
                    cast_error("s", strict_double("s")).alias("e")).collect()
    assert [r.d for r in got] == [None, 12.0, None, None, None, None, None, 529900.0, -350.0]
    assert [r.l for r in got] == [None, 12, None, None, None, None, None, 529900, -350]
    assert [r.e for r in got] == [True, False, True, True, True, False, False, False, False]


def test_dates_and_text(spark):
    r = spark.range(1).select(
        month_end_from_yyyymm(F.lit("202402")).alias("a"), month_end_from_yyyymm(F.lit("202413")).alias("b"),
        quarter_end(F.lit(2024), F.lit(3)).alias("c"), quarter_end(F.lit(2024), F.lit(5)).alias("d"),
        sentinel_number(F.lit("( 2.56)")).alias("e"), sentinel_number(F.lit("-")).alias("f"),
        normalise_name(F.lit("St. Louis, MO-IL")).alias("g"), strip_ansi(F.lit("\u001b[31mboom\u001b[0m ")).alias("h"),
    ).first()
    assert r.a == dt.date(2024, 2, 29) and r.b is None
    assert r.c == dt.date(2024, 9, 30) and r.d is None
    assert r.e == 2.56 and r.f is None
    assert r.g == "saint louis mo il" and r.h == "boom"


def test_null_safe_hash_separates_shifted_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    safe = {r[0] for r in df.select(row_hash(["x", "y", "z"])).collect()}
    legacy = {r[0] for r in df.select(row_hash(["x", "y", "z"], null_safe=False)).collect()}
    assert len(safe) == 2 and len(legacy) == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab|:~1", max_size=4)), min_size=3, max_size=3))
def test_hash_deterministic(spark, vals):
    df = spark.createDataFrame([tuple(vals)], "x string, y string, z string")
    a = df.select(row_hash(["x", "y", "z"])).first()[0]
    b = df.select(row_hash(["x", "y", "z"])).first()[0]
    assert a == b and len(a) == 32


def test_geo_key_and_period_date(spark):
    from medalloy.functions.dates import period_date
    from medalloy.functions.text import geo_key
    df = spark.createDataFrame([("MSA", " 10180 ", "quarterly", 2024, 4), ("State", "TX", "monthly", 2024, 12),
                                ("Other", "x", "quarterly", 2024, 12), ("MSA", "1", None, 2024, 1)],
                               "level string, pid string, f string, y int, p int")
    got = [(r.k.kind, r.k.id, r.d) for r in df.select(geo_key("level", "pid").alias("k"),
                                                      period_date("f", "y", "p").alias("d")).collect()]
    assert got == [("cbsa", "10180", dt.date(2024, 12, 31)), ("state", "TX", dt.date(2024, 12, 31)),
                   (None, "x", None), ("cbsa", "1", None)]
