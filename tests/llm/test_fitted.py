"""Parts of the fitted scores against plain counting: isotonic calibration, normal equations, the kernel."""

import random
from fractions import Fraction

import numpy as np

from medalloy.llm import fitting, quality


def test_isotonic_equals_the_max_min_formula():
    """The fit at i is the largest, over starts up to i, of the least mean of a stretch from there to beyond i."""
    rng = random.Random(3)
    for _ in range(80):
        n = rng.randrange(1, 14)
        s = sorted(rng.sample(range(1000), n))
        y, w = [rng.randrange(2) for _ in s], [rng.randrange(1, 5) for _ in s]

        def mean(a, b, v):
            return Fraction(sum(w[i] * v[i] for i in range(a, b + 1)), sum(w[a:b + 1]))

        fit = [max(min(mean(a, b, y) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        base, blocks, at = mean(0, n - 1, y), [], 0
        while at < n:
            end = max(i for i in range(at, n) if fit[i] == fit[at])
            weight = sum(w[at:end + 1])
            blocks.append((float(mean(at, end, s)), float((fit[at] * weight + base) / (weight + 1))))
            at = end + 1
        mixed = list(range(n))
        rng.shuffle(mixed)
        x, v = fitting.isotonic(*(np.array([c[i] for i in mixed], float) for c in (s, y, w)))
        assert np.allclose(x, [b[0] for b in blocks]) and np.allclose(v, [b[1] for b in blocks])
    assert fitting.calibrate(fitting.isotonic(*(np.array([]),) * 3), np.array([-3.0, 9.0])).tolist() == [0.5, 0.5]


def test_normal_equations_equal_plain_sums(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(45, quality.STATS)), rng.integers(0, 2, 45).astype(float)
    mean, scale = x.mean(0), x.std(0)
    rows = spark.createDataFrame([(r.tolist(), t) for r, t in zip(x, y.tolist(), strict=True)], "x array<double>, y double")
    a, b, n = quality._normal_equations(rows.repartition(7), mean, scale)
    size = quality.COSINES + quality.STATS + 1
    want_a, want_b = np.zeros((size, size)), np.zeros(size)
    for r, t in zip(x, y, strict=True):
        f = quality.cosines(r[None, :], mean, scale)[0]
        want_a += np.outer(f, f)
        want_b += f * t
    assert n == 45 and np.allclose(a, want_a) and np.allclose(b, want_b)
    assert quality._normal_equations(rows.limit(0), mean, scale) is None


def test_random_cosines_approximate_a_gaussian_kernel():
    """Products of the features of two rows are near exp(-width^2 |z - z'|^2 / 2)."""
    rng = np.random.default_rng(8)
    z = rng.normal(size=(60, quality.STATS))
    f = quality.cosines(z, np.zeros(quality.STATS), np.ones(quality.STATS))[:, :quality.COSINES]
    d2 = ((z[:, None] - z[None]) ** 2).sum(2)
    gap = f @ f.T - np.exp(-quality.WIDTH ** 2 * d2 / 2)
    assert np.abs(gap).mean() < 0.06 and np.abs(gap).max() < 0.35


def test_pipeline_stages_on_odd_rows(spark, sf):
    """Null, empty and repeated texts, rows without an id, columns named like the stages' own, and no rows at all."""
    import corpus_pipeline as cp

    like = spark.read.parquet(f"{sf}/documents.parquet")
    own = ["__score", "__was", "__leaks", "__key", "__clean", "__CLEAN_", "class_id"]
    rows = [(1, None), (2, ""), (3, "a plain text with token = abcdef123456 inside"), (3, "a plain text with token = abcdef123456 inside"),
            (None, "other words that nobody else has"), (None, None)]
    odd = spark.createDataFrame([(*r, "en", "src", 7, *own) for r in rows],
                                "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in own))
    assert set(like.columns) <= set(odd.columns)
    for name, stage in cp.STAGES:
        got, empty = stage(spark, odd, sf), stage(spark, odd.limit(0), sf)
        assert empty.columns == got.columns and empty.count() == 0
        if name == cp.STAGES[-1][0]:
            assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in got.collect()) == [(0, False), (0, True), (1, False), (2, False), (3, True), (3, True)]
            continue
        assert got.columns == odd.columns
        kept = got.collect()
        assert all([r[c] for c in own] == own for r in kept)
        if name == "MinHash near-dedup":
            assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted({str(r) for r in rows})
        elif name == "secret scans":
            assert sorted(str(r.text) for r in kept) == sorted(str(t).replace("token = abcdef123456", "[SECRET]") for _, t in rows)
        elif name == "benchmark decontamination":
            assert len(kept) == len(rows)
