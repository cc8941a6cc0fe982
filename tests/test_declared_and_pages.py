"""Declared keys, page chains, CSV fields, exact headers, natural bands, polygons with parts and holes."""

import itertools
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.operators import checks as ck
from medalloy.operators import constraints as cn
from medalloy.operators import metrics as mx
from medalloy.operators import spatial as sp
from medalloy.sources import files as fs
from medalloy.sources import json_pages as jp
from medalloy.store import TableSpec, TableStore, column, describe


def _spec(name, keys=(), **fks):
    return TableSpec(name, T.StructType([]), keys=keys, foreign_keys=fks)


def test_dependency_order():
    specs = [_spec("fact", a=("dim", "k"), b=("cal", "k")), _spec("dim", p=("top", "k")), _spec("cal"), _spec("top", own=("top", "k"))]
    assert [s.name for s in cn.dependency_order(specs)] == ["top", "dim", "cal", "fact"]
    with pytest.raises(ValueError, match="cycle: a -> b -> a"):
        cn.dependency_order([_spec("a", x=("b", "k")), _spec("b", x=("a", "k"))])
    with pytest.raises(ValueError, match="undeclared"):
        cn.dependency_order([_spec("a", x=("nowhere", "k"))])


def test_check_report(spark):
    fact = spark.createDataFrame([(1, "x", 7), (1, "x", 7), (2, None, 8), (3, "y", None), (1, "1:x", 9), (11, "", 7)], "a int, b string, d long")
    dim = spark.createDataFrame([(7,), (None,), (9,)], "k int")
    specs = [_spec("fact", ("a", "b"), d=("dim", "k")), _spec("dim", ("k",))]
    got = {r.constraint: tuple(r)[6:] for r in cn.check_report({"fact": fact, "dim": dim}, specs).collect()}
    # rows, null rows, broken keys, broken rows
    assert got == {"pk_dim": (3, 1, 1, 1), "pk_fact": (6, 1, 2, 3), "fk_fact_d": (6, 1, 1, 1)}
    none = {r.constraint: tuple(r)[6:] for r in cn.check_report({"fact": fact.limit(0), "dim": dim.limit(0)}, specs).collect()}
    assert set(none.values()) == {(0, 0, 0, 0)} and len(none) == 3


def test_counts_by_name(spark):
    spark.range(3).createOrReplaceTempView("counted_a")
    spark.range(5).createOrReplaceTempView("counted_b")
    assert sorted(map(tuple, ck.counts_by_name(spark, ["counted_a", "counted_b"]).collect())) == [("counted_a", 3), ("counted_b", 5)]


def test_describe(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="described-", dir="/tmp"))
    spec = TableSpec("t", T.StructType([column("k", T.IntegerType(), "the key"), column("v", T.StringType())]))
    assert store.create_if_absent([spec]) == {"t": "created"} and store.create_if_absent([spec]) == {"t": "exists"}
    assert list(map(tuple, describe(store, ["t"]).collect())) == [("t", 1, "k", "int", "the key", 0), ("t", 2, "v", "string", "", 0)]


def test_csv_fields(spark):
    cases = {'a,b': ["a", "b"], ',a,': [None, "a", None], '"x, ""y""",2': ['x, "y"', "2"], ' a , " b" ': ["a", '" b"'], '""': [None], '"l\nm",n': ["l\nm", "n"],
             "": [None], '"a"b,c': ["a", "c"]}
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    got = {r.r: r.f for r in df.select("r", fs.csv_fields(F.col("r")).alias("f")).collect()}
    assert got == cases


def test_ragged_records(spark):
    files = [("a", "﻿ID,NAME,X\r\nUS1,\"Oak, \"\"N\"\"\nTown\",\r\nUS2,Elm\r\n"), ("b", "X,ID,X\n1,US3,2\nCA4,5\n"), ("c", "ID\n"), ("d", ""), ("e", None)]
    df = spark.createDataFrame(files, "file_path string, content string")
    got = fs.parse_ragged(df, ["ID", "X", "NAME"], id_col="ID", keep_prefix="US")
    assert sorted(tuple(r) for r in got.collect()) == [("US1", None, 'Oak, "N"\nTown', "a"), ("US2", None, "Elm", "a"), ("US3", "1", None, "b")]
    assert fs.require_rows(got, "stations") is got
    with pytest.raises(fs.NoRows, match="stations"):
        fs.require_rows(fs.parse_ragged(df.where("file_path > 'b'"), ["ID"], id_col="ID"), "stations")
    assert "Python" not in got._jdf.queryExecution().toString()


def test_exact_header_is_checked_by_the_load(spark):
    d = tempfile.mkdtemp(prefix="exact-", dir="/tmp")
    with open(os.path.join(d, "good.csv"), "w") as f:
        f.write("date,value\n2024-01-01,1.5\n")
    got = fs.read_csv_exact(spark, d, ["date", "value"], ["day", "v"])
    assert list(map(tuple, got.collect())) == [("2024-01-01", "1.5")] and got.columns == ["day", "v"]
    with open(os.path.join(d, "bad.csv"), "w") as f:
        f.write("value,date\n.,2024-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        fs.read_csv_exact(spark, d, ["date", "value"]).collect()


def test_manifest(spark):
    manifest = spark.createDataFrame([("a.csv", "A")], "file_name string, series_id string")
    known = fs.manifest_lookup(spark.createDataFrame([("/x/a.csv",)], "source_file_path string"), manifest)
    fs.enforce_manifest(known)
    with pytest.raises(ValueError, match="2 files not in the manifest, first /x/b.csv"):
        fs.enforce_manifest(fs.manifest_lookup(spark.createDataFrame([("/x/a.csv",), ("/x/b.csv",), ("/x/b.csv",), ("/y/c.csv",)], "source_file_path string"), manifest))


def test_page_chains(spark):
    def page(n, more):
        return json.dumps({"features": [{"attributes": {"i": i}} for i in range(n)], **({} if more is None else {"exceededTransferLimit": more})})

    rows = [("good", 0, page(2, True)), ("good", 1, page(1, None)), ("gap", 0, page(2, True)), ("gap", 2, page(1, False)), ("early", 0, page(2, False)),
            ("early", 1, page(2, False)), ("open", 0, page(1, True)), ("twice", 0, page(1, False)), ("twice", 0, page(1, False)), ("empty", 0, page(0, False)),
            ("torn", 0, "{not json")]
    rep = jp.chain_report(spark.createDataFrame(rows, "chain string, no int, page string"), "chain", "no", "page")
    got = {r.chain: tuple(r)[1:] for r in rep.collect()}
    assert got == {"good": (2, 3, 0, 0, 0, False, True), "gap": (2, 3, 1, 0, 0, False, False), "early": (2, 4, 0, 0, 1, False, False),
                   "open": (1, 1, 0, 0, 0, True, False), "twice": (2, 2, 0, 1, 0, False, False), "empty": (1, 0, 0, 0, 0, False, False),
                   "torn": (1, 0, 0, 0, 0, False, False)}
    jp.require_whole(rep.where("chain = 'good'"), "chain")
    with pytest.raises(jp.BrokenChain, match="1 of 2 page chains are not whole, first gap"):
        jp.require_whole(rep.where("chain in ('good', 'gap')"), "chain")
    with pytest.raises(jp.BrokenChain, match="0 of 0"):
        jp.require_whole(rep.limit(0), "chain")


def test_least_square_cuts_against_all_cuts():
    rnd = random.Random(2)
    for _ in range(200):
        m, k = rnd.randint(1, 9), rnd.randint(1, 4)
        x, n = sorted(rnd.sample(range(30), m)), [rnd.randint(1, 5) for _ in range(m)]

        def cost(cuts):
            total = 0.0
            for a, b in cuts:
                v = [y for y, c in zip(x[a:b], n[a:b], strict=True) for _ in range(c)]
                total += sum((y - sum(v) / len(v)) ** 2 for y in v)
            return total

        every = [list(itertools.pairwise([0, *c, m])) for c in itertools.combinations(range(1, m), min(k, m) - 1)]
        got = mx.least_square_cuts(x, n, k)
        assert got in every and abs(cost(got) - min(map(cost, every))) < 1e-9


def test_natural_breaks_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.004,), (9.0,), (None,), (float("nan"),), (float("inf"),)], "s double")
    assert list(map(tuple, mx.natural_breaks(df, "s", 5).collect())) == [(1, 1.0, 1.0, 2), (2, 9.0, 9.0, 1)]
    assert mx.natural_breaks(df.limit(0), "s", 5).count() == 0


def test_polygons_with_parts_and_holes(spark):
    rnd = random.Random(11)
    for size in (1.0, 0.01, 700.0):
        polys = []
        for i in range(6):
            rings = []
            for _ in range(rnd.randint(1, 4)):
                cx, cy, r = rnd.uniform(-4, 4), rnd.uniform(-4, 4), rnd.uniform(0.5, 4)
                rings.append([(size * round(cx + r * a, 1), size * round(cy + r * b, 1)) for a, b in ((-1, -1), (1, -1), (1.2, 0.1), (1, 1), (-0.3, 0.2), (-1, 1))])
            polys.append((i, rings))
        pts = [(j, size * round(rnd.uniform(-8, 8), 1), size * round(rnd.uniform(-8, 8), 1)) for j in range(400)]

        def inside(px, py, rings):
            odd = False
            for ring in rings:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
                    if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                        odd = not odd
            return odd

        want = {j: min(hit) for j, px, py in pts if (hit := [i for i, rings in polys if inside(px, py, rings)])}
        p = spark.createDataFrame(pts, "point_id int, x double, y double")
        g = spark.createDataFrame(polys, "polygon_id int, ring array<array<struct<x:double,y:double>>>")
        assert {r.point_id: r.polygon_id for r in sp.within(p, g).collect()} == want
        cells, rows = sp.cover(sp.polygon_edges(g))
        met = sp.candidates(p.select(F.col("point_id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py")), cells)
        tested = met.where("not inner").join(rows, ["polygon_id", "cy"]).count()
        assert cells.where("inner").count() > 0 and tested < 400 * sum(len(r) for _, rings in polys for r in rings) / 4
    none = spark.createDataFrame([], "polygon_id int, ring array<array<struct<x:double,y:double>>>")
    assert sp.within(p, none).count() == 0
