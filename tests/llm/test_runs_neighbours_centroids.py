"""Periodic runs, neighbours by stable projections, centroid clustering: brute force and edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from medalloy.llm import centroid_walk, periodic_runs, queries, stable_ann

SF = "/root/testdata/sf0.001"


def plain_runs(w, least):
    """All maximal stretches of each period, without those of a smaller period."""
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            m = i + q - start
            if i > start and m >= max(least, 2 * q):
                own = w[start:start + m]
                if all(any(own[x] != own[x + r] for x in range(m - r)) for r in range(1, q)):
                    found.append((start, m, q))
            i = i + 1 if i == start else i
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(rnd):
    n, k = rnd.randint(0, 40), rnd.choice([1, 2, 2, 3, 4])
    w = [rnd.randint(1, k) for _ in range(n)]
    if n and rnd.random() < 0.5:
        p = rnd.randint(1, max(1, n // 2))
        w = [w[i % p] for i in range(n)]
        if rnd.random() < 0.5:
            w[rnd.randrange(n)] = 1
    return w, k


def test_lyndon_lengths_against_all_factors():
    rnd = random.Random(5)
    for _ in range(400):
        w, k = words_of(rnd)
        longest = [max(j - i for j in range(i + 1, len(w) + 1) if all(w[i:j] < w[i + x:j] for x in range(1, j - i))) for i in range(len(w))]
        assert periodic_runs.lyndon_lengths([0, *w, 0], k + 1)[1:-1] == longest


def test_runs_against_all_periods():
    rnd = random.Random(6)
    for _ in range(400):
        texts = [words_of(rnd)[0] for _ in range(rnd.randint(1, 4))]
        starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
        has = np.array([len(t) > 0 for t in texts])
        flat = np.array([x for t in texts for x in t], np.int64)
        for least in (2, 5, 12):
            want = [(a + int(s), m, q) for s, t in zip(starts, texts, strict=True) for a, m, q in plain_runs(t, least)]
            assert [tuple(r) for r in periodic_runs.runs_of(flat, starts[has], least).tolist()] == want


def test_run_query_against_its_statement(spark):
    """Every row of the query, from the statement alone."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs)
    runs_seen = 0
    for i, text in docs.items():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if x < a else words[a + (x - a) % p] for x, w in enumerate(words)]
        if n > 1500:  # the plain search is quadratic
            continue
        runs = plain_runs(words, 12)
        runs_seen += len(runs)
        dropped = {x for s, m, q in runs for x in range(s + q, s + m)}
        kept = b" ".join(w for x, w in enumerate(words) if x not in dropped)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * top[1] // top[2] if runs else None
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert tuple(got[i]) == (i, len(runs), *top, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    assert runs_seen > 10


def test_run_edges(spark):
    long = "lead " + "a b c d e f g " * 3000 + "x" * 20_000
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "no no no"), (5, long), (5, long), (None, "z " * 12), (6, "z " * 11), (7, "é\x1fé " * 14)]
    docs = spark.createDataFrame([(i, t, "mine", 7) for i, t in rows], "doc_id long, text string, runs string, start long")
    got = periodic_runs.detect(docs)
    assert got.columns == ["doc_id", "text", "start", "n_words", "runs", "collapsed"]
    seen = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    assert [s for s in seen if s[0] in (1, 2, 3)] == [(i, 0, [], "") for i in (1, 2, 3)]
    assert [s for s in seen if s[0] == 4] == [(4, 2, [], "no no no")]
    assert [s for s in seen if s[0] == 5] == 2 * [(5, 21_002, [(1, 21_000, 7)], "lead a b c d e f g " + "x" * 20_000)]
    assert [s for s in seen if s[0] is None] == [(None, 12, [(0, 12, 1)], "z")] and [s for s in seen if s[0] == 6][0][2] == []
    assert [s for s in seen if s[0] == 7] == [(7, 14, [(0, 14, 1)], "é\x1fé")]
    assert periodic_runs.detect(docs.limit(0)).count() == 0
    plain = queries.with_planted_runs(spark.createDataFrame([(None, "a b"), (24, None), (24, "")], "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in plain), key=str) == sorted([(None, "a b"), (24, None), (24, "")], key=str)


def nearest(ids, x, k, of):
    d = np.sqrt(((x - x[of]) ** 2).sum(1))
    rows = [i for i in np.lexsort((ids, d)) if ids[i] != ids[of]]
    return [(int(ids[i]), float(d[i])) for i in rows[:k]]


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert all([r[0] for r in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [r[1:] for r in sorted(v)] for q, v in out.items()}


def test_chi_square():
    assert abs(float(stable_ann.chi_square_cdf(15.507, 8)) - 0.95) < 1e-4 and abs(stable_ann.chi_square_bound(0.95, 2) - 5.9915) < 1e-3


def test_neighbour_recall(spark):
    """Recall against brute force over small blocks and many cells; scores are exact."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((4000, 24)) * (1 + rng.integers(0, 3, (4000, 1)))
    ids = np.arange(4000) * 7
    rows = stable_ann.valid_vectors(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "k long, e array<double>"), "k", "e")
    got = answers(stable_ann.neighbours(rows.where("vec_id % 100 = 0"), rows, k=10, block=256))
    hits = 0
    asked = np.flatnonzero(ids % 100 == 0)
    for of in asked:
        want, own = nearest(ids, x, 10, of), got[int(ids[of])]
        assert len(own) == 10 and all(abs(s - float(np.sqrt(((x[i // 7] - x[of]) ** 2).sum()))) < 1e-12 for i, s in own)
        hits += len({w[0] for w in want} & {o[0] for o in own})
    assert len(got) == len(asked) and hits / (10 * len(asked)) >= 0.97


def test_neighbour_verifies_less_than_all():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 32)) * 0.05 + rng.integers(0, 20, (4000, 1))
    p = x @ stable_ann.projection(32)
    tree, ones = stable_ann.KdTree(p), np.ones(4000, np.int64)
    made = [stable_ann.search(x[i], p[i], tree, x, np.arange(4000), ones, 10, stable_ann.chi_square_bound(0.98, 8))[1] for i in range(0, 4000, 400)]
    assert np.mean(made) < 1000


def test_neighbour_edges(spark):
    """Hot equal vectors, ties, null ids, repeated ids and bad vectors."""
    one, two, far = [1.0, 0.0, 0.0], [1.0, 1.0, 0.0], [5.0, 5.0, 5.0]
    rows = [(100 + i, one) for i in range(40)] + [(0, one), (200, two), (200, two), (300, far), (None, two), (5, two), (5, two),
            (6, None), (7, []), (8, [0.0, 0.0, 0.0]), (9, [1.0, None, 0.0]), (10, [1.0, float("nan"), 0.0]), (11, [1.0, float("inf"), 0.0]),
            (400, [3.0, 4.0]), (12, [0.0, 4.0])]
    df = spark.createDataFrame([(i, v, 0.5, "x") for i, v in rows], "vec_id long, e array<double>, score double, cell string")
    vectors = stable_ann.valid_vectors(df, "vec_id", "e")
    got = answers(stable_ann.neighbours(vectors.where("vec_id % 100 = 0"), vectors, k=10, block=8))
    assert got[0] == [(100 + i, 0.0) for i in range(10)] and got[100] == [(0, 0.0)] + [(101 + i, 0.0) for i in range(9)]
    assert got[200] == [(5, 0.0), (5, 0.0), (None, 0.0), (0, 1.0)] + [(100 + i, 1.0) for i in range(6)]
    assert [i for i, _ in got[300]] == [5, 5, 200, 200, None, 0, 100, 101, 102, 103]
    assert got[400] == [(12, 3.0)] and set(got) == {0, 100, 200, 300, 400}
    none = vectors.limit(0)
    assert stable_ann.neighbours(none, none).count() == 0 and stable_ann.neighbours(vectors.where("vec_id = 400"), none).count() == 0


def test_nearest_centroid_against_all():
    rng = np.random.default_rng(3)
    for _ in range(100):
        n, d, k = rng.integers(1, 200), rng.integers(1, 12), rng.integers(1, 10)
        c, x = rng.integers(-5, 6, (k, d)), rng.integers(-6, 7, (n, d))
        number, best, _ = centroid_walk.SortedLists(c).nearest(x)
        far = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (number == far.argmin(1)).all() and (best == far.min(1)).all()
    c, x = rng.integers(-30, 30, (200, 3)), rng.integers(-30, 30, (1000, 3))
    assert centroid_walk.SortedLists(c).nearest(x)[2] < 100_000  # half of all distances


def plain_clusters(ids, x, k, rounds):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"1:{ids[i]}".encode()).hexdigest(), x[i].tolist()))[:k]
    c = [[int(v) for v in x[i]] for i in order]
    for step in range(rounds + 1):
        own = [min(range(len(c)), key=lambda j: (sum((int(a) - b) ** 2 for a, b in zip(v, c[j], strict=True)), j)) for v in x]
        if step < rounds:
            c = [[sum(int(x[i][d]) for i in mine) // len(mine) for d in range(len(c[j]))] if (mine := [i for i, o in enumerate(own) if o == j]) else c[j]
                 for j in range(len(c))]
    return {i: (o, sum((int(a) - b) ** 2 for a, b in zip(v, c[o], strict=True))) for i, v, o in zip(ids, x, own, strict=True)}, c


@pytest.mark.parametrize("n,k", [(300, 16), (5, 8)])
def test_clusters_against_plain(spark, n, k):
    rng = np.random.default_rng(n)
    x = np.floor(64 * (rng.standard_normal((n, 4)) - 0.2)).astype(int)
    df = spark.createDataFrame([(i, (v / 64).tolist()) for i, v in enumerate(x)], "i long, e array<double>")
    rows, c = centroid_walk.cluster(centroid_walk.integer_vectors(df, "i", "e", dims=4, scale=64), k=k)
    want, means = plain_clusters(list(range(n)), x, k, 3)
    assert {r.vec_id: (r.cluster, r.distance) for r in rows.collect()} == want and c.tolist() == means


def test_cluster_edges(spark):
    good = [0.5, -0.01]
    rows = [(1, good), (1, good), (2, good), (None, good), (3, None), (4, [1.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("-inf"), 1.0]),
            (8, [1e30, 1.0]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, v array<float>, cluster string")
    vectors = centroid_walk.integer_vectors(df, "vec_id", "v", dims=2, scale=64)
    assert sorted((r.vec_id or 0, list(r.v)) for r in vectors.collect()) == [(0, [32, -1]), (1, [32, -1]), (1, [32, -1]), (2, [32, -1])]
    done = centroid_walk.with_inertia(*centroid_walk.cluster(vectors, k=3))
    assert sorted((r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia) for r in done.collect()) == [(i, 0, 0, 0, 0) for i in (0, 1, 1, 2)]
    assert {r.centroid_sha256 for r in done.collect()} == {hashlib.sha256(b"32,-1").hexdigest()}
    none = centroid_walk.with_inertia(*centroid_walk.cluster(vectors.limit(0)))
    assert none.count() == 0 and none.columns == done.columns
    kinds = spark.range(3).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("e"))
    assert centroid_walk.cluster(centroid_walk.integer_vectors(kinds, "vec_id", "e", 2, 64), k=2)[0].count() == 3
