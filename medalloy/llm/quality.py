"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

A text becomes 22 statistics of its whole length (sizes, character classes, repetition, lines).
Random cosines of the standardised statistics approximate a Gaussian kernel. Every partition of
the labelled sample adds up its normal equations; their sum, of a size fixed by the number of
features, is solved on the driver. Scores of rows left out of the fit calibrate the output.

Learnt from a bounded, documented sample (``SAMPLE_ROWS`` labelled rows). Defined results: a
null or empty text has zero statistics and the base rate of label 1 as score, as have all texts
if no row is labelled (0.5 then); repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, cut, received, send
from medalloy.llm.fitting import SAMPLE_ROWS, calibrate, isotonic, labelled_sample

STATS = 22
COSINES = 256
RIDGE = 1e-3
WIDTH = 0.25  # inverse kernel width on standardised statistics
_STOPS = frozenset(map(ord, ".!?"))
_PUNCT = frozenset(map(ord, ",;:.!?'\"()-"))


def statistics(text: str) -> list[float]:
    """The statistics of a whole text; an empty one gives zeros."""
    if not text:
        return [0.0] * STATS
    h = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    n = int(h.sum())
    upper, lower, digit = int(h[65:91].sum()), int(h[97:123].sum()), int(h[48:58].sum())
    ascii_print = int(h[33:127].sum())
    punct = sum(int(h[c]) for c in _PUNCT)
    symbol = ascii_print - upper - lower - digit - punct
    p = h[h > 0] / n
    words = text.split()
    m = len(words)
    if not m:
        return [math.log1p(n)] + [0.0] * (STATS - 1)
    counts = Counter(words)
    top = max(counts.values())
    repeat = sum(map(eq, words, words[1:]))
    pairs = sum(map(eq, words, words[2:]))
    lens = np.fromiter(map(len, words), np.int64, m)
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    ends = sum(int(h[c]) for c in _STOPS)
    letters = upper + lower + int(h[128:].sum())
    return [
        math.log1p(n), math.log1p(m), float(lens.mean()), float(lens.std()), math.log1p(int(lens.max())),
        upper / n, digit / n, punct / n, symbol / n, int(h[128:].sum()) / n, letters / n, int(h[:32].sum()) / n,
        float(-(p * np.log2(p)).sum()), len(counts) / m, top / m, repeat / m, pairs / m, ends / m,
        float((lens <= 3).mean()), len(set(filled)) / max(1, len(filled)), m / max(1, len(filled)),
        upper / max(1, upper + lower),
    ]


def cosines(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features with a constant; directions are fixed by a seed."""
    rng = np.random.default_rng(20240117)
    w = rng.normal(0, WIDTH, (STATS, COSINES))
    b = rng.uniform(0, 2 * math.pi, COSINES)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.cos(z @ w + b) * math.sqrt(2 / COSINES), z, np.ones((len(x), 1))])


class Model:
    """Standardisation, ridge weights, calibration and base rate."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray | None, points, base: float):
        self.mean, self.scale, self.weights, self.points, self.base = mean, scale, weights, points, base

    def raw(self, x: np.ndarray) -> np.ndarray:
        return cosines(x, self.mean, self.scale) @ self.weights

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.base)
        some = [i for i, t in enumerate(texts) if t]
        if some and self.weights is not None:
            out[some] = calibrate(self.points, self.raw(np.array([statistics(texts[i]) for i in some])))
        return out


def fit(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Fits on the labelled sample; a quarter of it, by a hash of the id, is left for calibration."""
    sample = labelled_sample(docs, labels, label_col, train, id_col, text_col, rows).where("text <> ''")
    fields = [T.StructField("x", T.ArrayType(T.DoubleType(), False))]
    x = cut(append_columns(sample, "text", lambda: lambda texts: [[statistics(t) for t in texts]], fields, keep=["id", "y"])
            .withColumn("fold", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4))))
    sums = x.select(F.count(F.lit(1)).alias("n"), F.avg("y").alias("base"),
                    *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(STATS)),
                    *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(STATS))).first()
    mean, scale = np.zeros(STATS), np.ones(STATS)
    if not sums["n"]:
        return Model(mean, scale, None, None, 0.5)
    mean = np.array([sums[f"m{i}"] for i in range(STATS)])
    scale = np.maximum([sums[f"s{i}"] for i in range(STATS)], 1e-6)
    left = _normal_equations(x.where("fold > 0"), mean, scale)
    if left is None:
        return Model(mean, scale, None, None, sums["base"])
    a, b, n = left
    model = Model(mean, scale, np.linalg.solve(a + RIDGE * max(1.0, n) * np.eye(len(a)) / 100, b), None, sums["base"])
    seen = _binned(x.where("fold = 0"), model)
    if not len(seen[0]):
        seen = _binned(x, model)
    model.points = isotonic(*seen)
    return model


def _normal_equations(x: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Sums of f f' and f y over the rows: one partial matrix per partition, added up by row on executors."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("row", T.ArrayType(T.DoubleType(), False))])
    size = COSINES + STATS + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                f = cosines(np.array(batch.column(0).to_pylist()), mean, scale)
                total += f.T @ np.hstack([f, np.array(batch.column(1).to_pylist())[:, None]])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                                             names=schema.names)

    few = x.select("x", "y").coalesce(8).mapInArrow(part, schema)
    rows = (few.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
            .groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("r")).select("i", F.col("r.v").alias("v")).collect())
    if not rows:
        return None
    m = np.array([r.v for r in sorted(rows, key=lambda r: r.i)])
    return m[:, :-1], m[:, -1], int(round(m[-1, -2]))


def _binned(x: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean score, mean label and count per thousandth of the raw score: bounded, whatever the rows."""
    schema = T.StructType([T.StructField("s", T.DoubleType()), T.StructField("y", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(model.raw(np.array(batch.column(0).to_pylist()))), batch.column(1)],
                                                 names=schema.names)

    rows = (x.select("x", "y").mapInArrow(run, schema).groupBy(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "s")), 3).alias("b"))
            .agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).collect())
    return tuple(np.array([r[c] for r in rows], float) for c in ("s", "y", "n"))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the calibrated score of each whole text."""
    sent = send(docs.sparkSession, model)

    def make():
        own = received(sent)
        return lambda texts: [own.score(texts)]

    return append_columns(docs, text_col, make, [T.StructField(out, T.DoubleType())], keep)
