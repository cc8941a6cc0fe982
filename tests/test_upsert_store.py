import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from medalloy.operators import upsert as up
from medalloy.store import DuplicateSourceKeys, TableSpec, TableStore, column, conform_to, hash_slot
from pyspark.sql import types as T


def _t(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k int, s string, v double")


def test_merge_kinds_and_idempotence(spark):
    t = _t(spark)
    s = spark.createDataFrame([(2, "b", 20.0), (4, "d", 4.0)], "k int, s string, v double")
    m = up.merge_upsert(t, s, "k")
    got = {r.k: (r.s, r.v, r._change) for r in m.collect()}
    assert got == {1: ("a", 1.0, "kept"), 2: ("b", 20.0, "update"), 3: ("c", None, "kept"), 4: ("d", 4.0, "insert")}
    again = up.merge_upsert(m.drop("_change", "_src_rows"), s, "k").drop("_change", "_src_rows")
    assert sorted(again.collect()) == sorted(m.drop("_change", "_src_rows").collect())


def test_hash_guard_null_safe(spark):
    t = spark.createDataFrame([(1, None, 1.0), (2, "h", 2.0)], "k int, row_hash string, v double")
    s = spark.createDataFrame([(1, None, 9.0), (2, "h", 9.0)], "k int, row_hash string, v double")
    got = {r.k: (r._change, r.v) for r in up.merge_upsert(t, s, "k", update="hash").collect()}
    assert got == {1: ("unchanged", 1.0), 2: ("unchanged", 2.0)}


def test_set_keeps_inserted(spark):
    t = spark.createDataFrame([(1, 1.0, dt.date(2020, 1, 1), dt.date(2020, 1, 1))], "k int, v double, ins date, upd date")
    s = spark.createDataFrame([(1, 2.0, dt.date(2021, 1, 1), dt.date(2021, 1, 1))], "k int, v double, ins date, upd date")
    r = up.merge_upsert(t, s, "k", update=["v"], touch={"upd": F.lit(dt.date(2022, 1, 1))}).first()
    assert (r.v, r.ins, r.upd) == (2.0, dt.date(2020, 1, 1), dt.date(2022, 1, 1))


def test_priority_later_wins(spark):
    h = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    snap = spark.createDataFrame([(2, 22.0)], "k int, v double")
    both = up.prioritise([h, snap], "p")
    empty = both.limit(0)
    got = {r.k: r.v for r in up.merge_upsert(empty, both, "k", order=["p"]).collect()}
    assert got == {1: 1.0, 2: 22.0}


def test_replace_by_drops_processed_without_rows(spark):
    t = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "src string, n int")
    s = spark.createDataFrame([("x", 10)], "src string, n int")
    got = sorted(tuple(r) for r in up.replace_by(t, s, "src", ["x", "y"]).collect())
    assert got == [("x", 10), ("z", 3)]


def test_surrogates_stable(spark):
    t = spark.createDataFrame([("b", 1), ("d", 2)], "n string, key long")
    s = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "n string")
    got = {r.n: r.key for r in up.assign_surrogates(t, s, "n", "key").collect()}
    assert got == {"b": 1, "d": 2, "a": 3, "c": 4}


def test_store_and_duplicate_guard(spark):
    root = tempfile.mkdtemp(prefix="store-", dir="/tmp")
    st = TableStore(spark, root)
    spec = TableSpec("t", T.StructType([column("k", T.IntegerType(), "key"), column("s", T.StringType()),
                                        column("v", T.DoubleType(), "value")]), keys=("k",))
    assert st.create_if_absent([spec]) == {"t": "created"}
    assert st.create_if_absent([spec]) == {"t": "exists"}
    st.write("t", _t(spark), slot=hash_slot(["k"], 2))
    res = st.upsert("t", spark.createDataFrame([(2, "b", 20.0), (4, "d", 4.0)], "k int, s string, v double"), ["k"], slot=hash_slot(["k"], 2))
    assert (res["insert"], res["update"]) == (1, 1) and res["rows_written"] == 2 + res["kept"]
    assert st.read("t").count() == 4 and st.read("t").columns == ["k", "s", "v"]
    before = set(st.read("t").inputFiles())
    with pytest.raises(DuplicateSourceKeys):
        st.upsert("t", spark.createDataFrame([(5, "e", 1.0), (5, "f", 2.0)], "k int, s string, v double"), ["k"], slot=hash_slot(["k"], 2))
    assert set(st.read("t").inputFiles()) == before  # a refused batch writes nothing
    assert spec.comments()["k"] == "key"


def test_conform_to_adds_columns(spark):
    schema = T.StructType([column("k", T.IntegerType()), column("extra", T.StringType())])
    out = conform_to(spark.createDataFrame([(1,)], "k int"), schema)
    assert out.columns == ["k", "extra"] and out.first().extra is None


def test_incremental_stream(spark):
    from medalloy.streaming.incremental import upsert_new_files
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    land = os.path.join(base, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("k,v\n1,a\n2,b\n")
    st = TableStore(spark, os.path.join(base, "tables"))
    ck = os.path.join(base, "ck")
    upsert_new_files(spark, land, ["k", "v"], st, "bronze", ["k"], ck,
                     transform=lambda b: b.select("k", "v"))
    with open(os.path.join(land, "b.csv"), "w") as f:
        f.write("k,v\n2,bb\n3,c\n")
    upsert_new_files(spark, land, ["k", "v"], st, "bronze", ["k"], ck, transform=lambda b: b.select("k", "v"))
    assert sorted(tuple(r) for r in st.read("bronze").collect()) == [("1", "a"), ("2", "bb"), ("3", "c")]


def test_dense_positions_match_sorted_rank(spark):
    import random
    rnd = random.Random(3)
    keys = rnd.sample(range(1_000_000), 5000)
    df = spark.createDataFrame([(k, f"n{k % 7}") for k in keys], "k long, g string").repartition(13)
    got = {r.k: r._pos for r in up.dense_positions(df, ["k"]).collect()}
    want = {k: i + 1 for i, k in enumerate(sorted(keys))}
    assert got == want


def test_append_is_idempotent_by_batch(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="append-", dir="/tmp"))
    st.append("log", spark.createDataFrame([(1, "a")], "k int, s string"), batch="001")
    before = set(st.read("log").inputFiles())
    for _ in range(2):
        assert st.append("log", spark.createDataFrame([(2,), (3,)], "k int"), batch="01")["rows_written"] == 2
        assert before < set(st.read("log").inputFiles())
        assert sorted(tuple(r) for r in st.read("log").collect()) == [(1, "a"), (2, None), (3, None)]
    with pytest.raises(ValueError, match="not in the declared schema"):
        st.append("log", spark.createDataFrame([(2, 3)], "k int, other int"), batch="02")


def test_upsert_rewrites_touched_slots_only(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="slots-", dir="/tmp"))
    t = spark.createDataFrame([(k, y, 1.0) for k in range(20) for y in (1998, 1999)] + [(None, 1999, 1.0)], "k int, y int, v double")
    st.write("t", t, slot=F.col("y"))
    files = {r.slot: r.file_path for r in st.files("t").groupBy("slot").agg(F.min("file_path").alias("file_path")).collect()}
    res = st.upsert("t", spark.createDataFrame([(3, 1999, 9.0), (77, 1999, 7.0)], "k int, y int, v double"), ["k", "y"], slot=F.col("y"))
    assert (res["insert"], res["update"], res["kept"]) == (1, 1, 20)
    now = {r.slot: r.file_path for r in st.files("t").groupBy("slot").agg(F.min("file_path").alias("file_path")).collect()}
    assert now[1998] == files[1998] and now[1999] != files[1999]
    assert st.read("t").count() == 42 and st.read("t").where("v = 9").count() == 1


def test_replace_by_empties_a_slot_without_new_rows(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="replace-", dir="/tmp"))
    st.write("q", spark.createDataFrame([("a/b", 1), ("c d", 2), ("e", 3), (None, 4)], "src string, n int"), slot=F.col("src"))
    keep = {r.file_path for r in st.files("q").where("slot = 'e' or slot is null").collect()}
    st.replace_by("q", spark.createDataFrame([("a/b", 10)], "src string, n int"), "src", ["a/b", "c d"])
    assert sorted((tuple(r) for r in st.read("q").collect()), key=str) == [("a/b", 10), ("e", 3), (None, 4)]
    assert keep <= {r.file_path for r in st.files("q").collect()}


def test_comments_survive_a_write(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="comment-", dir="/tmp"))
    spec = TableSpec("c", T.StructType([column("k", T.IntegerType(), "key"), column("v", T.StringType(), "value")]))
    st.write("c", conform_to(spark.createDataFrame([(1,)], "k int"), spec.schema))
    assert {f.name: f.metadata.get("comment") for f in st.read("c").schema} == {"k": "key", "v": "value"}


def test_null_natural_key_keeps_its_id(spark):
    s = spark.createDataFrame([("x",), (None,), (None,)], "n string")
    t = spark.createDataFrame([], "n string, key long")
    first = up.assign_surrogates(t, s, "n", "key")
    again = up.assign_surrogates(first, s, "n", "key")
    assert sorted(map(tuple, first.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert first.where("n is null").count() == 1


def test_stream_with_repeated_keys(spark):
    from medalloy.streaming.incremental import upsert_new_files
    base = tempfile.mkdtemp(prefix="stream2-", dir="/tmp")
    land = os.path.join(base, "landing")
    os.makedirs(land)
    st = TableStore(spark, os.path.join(base, "tables"))

    def load(name: str, text: str, table: str, order=()):
        with open(os.path.join(land, name), "w") as f:
            f.write(text)
        upsert_new_files(spark, land, ["k", "v"], st, table, ["k"], os.path.join(base, "ck-" + table), order=order,
                         transform=lambda b: b.select("k", "v"))

    load("a.csv", "k,v\n1,a\n1,b\n2,c\n", "ordered", ["v"])
    load("b.csv", "k,v\n2,d\n2,e\n", "ordered", ["v"])
    assert sorted(tuple(r) for r in st.read("ordered").collect()) == [("1", "b"), ("2", "e")]
    with pytest.raises(Exception, match="occurs 3 times"):
        load("c.csv", "k,v\n3,f\n", "plain")
    assert not st.exists("plain")
