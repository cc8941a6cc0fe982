import random
import re

import pandas as pd
from pyspark.sql import functions as F

from medalloy.operators import matching as mt
from medalloy.operators import spatial as sp
from medalloy.plans import match_plans as mp


def _py_norm(s):
    s = s.lower()
    s = s.replace("st.", "saint").replace("ste.", "sainte")
    s = re.sub(r"[^a-z0-9 ]", " ", s)
    return re.sub(r" +", " ", s).strip()


def test_indel_ratio():
    assert mt.indel_ratio("abc", "abc") == 100.0
    assert round(mt.indel_ratio("kitten", "sitting"), 4) == round(100 * 2 * 4 / 13, 4)


def test_best_match_equals_brute_force(spark, sf):
    left = mp.edited_names(spark, sf)
    right = mp.master(spark, sf)
    got = {r.p_partkey: (r.code, r.match_score) for r in mt.best_match(
        left, right, left_key="p_partkey", left_name="region_name", left_block="state", right_key="code",
        right_title="title", right_blocks="brands", right_names=F.array(F.col("title"))).collect()}
    lp = left.toPandas().rename(columns={"p_partkey": "key", "region_name": "name", "state": "block"})
    rp = right.toPandas().rename(columns={"brands": "blocks"})
    rp["names"] = rp["title"].map(lambda t: [t])
    want = mt.brute_force_best(lp, rp, _py_norm)
    assert got == want
    assert any(v[0] is None for v in got.values()) and any(v[1] == 100.0 for v in got.values())


def test_threshold_pairs_and_blank_blocks(spark):
    """Pairs that score exactly 80 (lengths 9 and 6, 15 and 10), rows and targets without a block."""
    left = spark.createDataFrame([(1, "abcdefxyz", "A"), (2, "abcdefghijuvwxy", "A"), (3, "delta echo", ""), (4, "delta echo", None),
                                  (5, "orphan", "Q"), (6, "zulu", "A")], "k long, name string, block string")
    right = spark.createDataFrame([(10, "abcdef", ["A"]), (20, "abcdefghij", ["A"]), (30, "delta echo", ["B"]), (40, "orphan", []),
                                   (50, "zulu", ["B"])], "code long, title string, blocks array<string>")
    got = {r.k: (r.code, r.match_score, r.match_title) for r in mt.best_match(
        left, right, left_key="k", left_name="name", left_block="block", right_key="code", right_title="title",
        right_blocks="blocks").collect()}
    assert got == {1: (10, 80, "abcdef"), 2: (20, 80, "abcdefghij"), 3: (30, 100, "delta echo"), 4: (30, 100, "delta echo"),
                   5: (40, 100, "orphan"), 6: (None, None, None)}
    lp = left.toPandas().rename(columns={"k": "key"})
    want = mt.brute_force_best(lp, right.toPandas(), _py_norm)
    assert {k: v[:2] for k, v in got.items()} == want


def test_ratio_candidates_lose_no_pair(spark):
    """Random strings of all short lengths: every pair at or over the threshold is a candidate and passes the counts."""
    rnd = random.Random(4)
    for percent, letters in ((80, "ab"), (80, "abcde "), (90, "abc"), (67, "abc"), (60, "abcd")):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14))) for _ in range(90)]
        texts += [t[:i] + t[i + 1:] for t in texts[:60] for i in (rnd.randrange(len(t)),) if len(t) > 1]
        df = spark.createDataFrame([(i, "B", t) for i, t in enumerate(texts)], "k long, blk string, txt string")
        found = {(r.a, r.b) for r in mt.ratio_candidates(df.select("blk", "txt").distinct(), df.select("blk", "txt").distinct(), percent).collect()}
        got = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if (a, b) in found}
        both = df.select(F.col("k").alias("i"), F.col("txt").alias("a")).crossJoin(df.select(F.col("k").alias("j"), F.col("txt").alias("b")))
        counted = {(r.i, r.j) for r in both.where(mt.may_reach(F.col("a"), F.col("b"), percent)).collect()}
        want = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if 200 * mt.lcs_len(a, b) >= percent * (len(a) + len(b))}
        assert want <= got and want <= counted
        if (percent, letters) == (80, "abcde "):
            assert len(got & counted) < len(texts) ** 2 / 4


def test_overrides(spark):
    m = spark.createDataFrame([(1, 10, 85.0, "fuzzy", True), (2, None, None, "unmatched", None)],
                              "k long, code long, match_score double, match_method string, needs_review boolean")
    ov = spark.createDataFrame([(2, 77), (99, 5)], "k long, code long")
    got = {r.k: (r.code, r.match_method, r.needs_review) for r in mt.apply_overrides(m, ov, key="k", code="code").collect()}
    assert got == {1: (10, "fuzzy", True), 2: (77, "manual", False)}


def _inside(px, py, ring):
    c = 0
    for i in range(len(ring)):
        (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % len(ring)]
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            c += 1
    return c % 2 == 1


def test_point_in_polygon_brute_force(spark, sf):
    pts = mp._points(spark, sf)
    polys = mp._polygons(spark, sf)
    got = {r.point_id: r.polygon_id for r in sp.within(pts, polys).collect()}
    rings = {r.polygon_id: [(p.x, p.y) for p in r.ring] for r in polys.collect()}
    want = {}
    for r in pts.collect():
        hit = [pid for pid, ring in rings.items() if _inside(r.x, r.y, ring)]
        if hit:
            want[r.point_id] = min(hit)
    assert got == want


def test_concave_polygon(spark):
    ring = [(0, 0), (10, 0), (10, 10), (5, 3), (0, 10)]  # V-shaped notch
    polys = spark.createDataFrame([(1, [{"x": float(x), "y": float(y)} for x, y in ring])],
                                  "polygon_id int, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 8.0), (3, 1.0, 8.0), (4, 11.0, 1.0)], "point_id int, x double, y double")
    got = {r.point_id for r in sp.within(pts, polys).collect()}
    assert got == {1, 3}
