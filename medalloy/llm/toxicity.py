"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

A lexicon of words and word beginnings is learnt from the labelled sample (terms far more usual
in toxic documents). Whole texts become dense features: lexicon densities, the nearness of
lexicon words to the second person, capitals, punctuation and obfuscation rates (tokens that
meet the lexicon only once digits, signs or stretched letters are undone). MLlib's
gradient-boosted trees learn on three quarters of the sample, the rest calibrates.

Learnt from a bounded, documented sample (``SAMPLE_ROWS`` labelled rows), so the lexicon is
bounded too. Defined results: a null or empty text gets the base rate of label 1, as do all
texts if the sample doesn't hold both labels (0.5 without any label); repeated rows are scored
each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, cut, received, send, slices
from medalloy.llm.fitting import SAMPLE_ROWS, calibrate, isotonic, labelled_sample

TREES, DEPTH = 12, 3
PREFIXES = (4, 5, 6)
LEAST_DOCS = 2
LEAST_ODDS = 2.5
FALSE_TERMS = 1.0
CACHE = 300_000
FEATURES = 18
# Second-person words of the four languages, and look-alike characters.
SECOND = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deiner ihr euch euer tú ti tus "
    "usted ustedes vosotros".split())
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_STRETCH = re.compile(r"(.)\1{2,}")
_NOT_WORD = re.compile(r"[\W_]+")


def plain(token: str) -> str:
    """Lower-cased token without the signs around it."""
    return _EDGE.sub("", token.lower())


def undone(token: str) -> list[str]:
    """Readings of a token once look-alikes, inner signs and stretched letters are undone."""
    low = token.lower()
    clear = _NOT_WORD.sub("", _EDGE.sub("", low).translate(LOOKALIKE))
    short = _STRETCH.sub(r"\1", clear)
    return [x for x in dict.fromkeys((clear, short, _STRETCH.sub(r"\1\1", clear), _NOT_WORD.sub("", low))) if x]


def terms(text: str) -> set[str]:
    """Distinct words of a text, and their beginnings marked by a star."""
    words = {plain(w) for w in text.split()}
    words.discard("")
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


class Lexicon:
    """Log-odds of learnt terms; turns a text into features."""

    def __init__(self, odds: dict[str, float]):
        self.words = {t: o for t, o in odds.items() if not t.endswith("*")}
        self.starts = {t[:-1]: o for t, o in odds.items() if t.endswith("*")}
        self.at: dict[str, int] = {}
        self.props = np.zeros((1024, 7))

    def _start(self, w: str) -> float:
        return max((self.starts.get(w[:k], 0.0) for k in PREFIXES if len(w) > k), default=0.0)

    def _row(self, token: str) -> list[float]:
        """(word odds, beginning odds, undone odds, second person, all capitals, changed, letters)."""
        w = plain(token)
        odds, start = self.words.get(w, 0.0), self._start(w)
        hidden, changed = 0.0, 0.0
        if w and not (w.isalpha() and not _STRETCH.search(w)):
            changed = float(any(c.isalpha() for c in w))
            if not odds:
                hidden = max((max(self.words.get(x, 0.0), self._start(x) if len(x) > 5 else 0.0) for x in undone(token)), default=0.0)
        return [odds, start, hidden, float(w in SECOND), float(len(w) > 1 and token.isupper()), changed, float(len(w))]

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        m = len(tokens)
        if not m:
            return [0.0] * FEATURES
        if len(self.at) > CACHE:
            self.at.clear()
        at = self.at
        for t in set(tokens).difference(at):
            if len(at) == len(self.props):
                self.props = np.concatenate([self.props, np.zeros_like(self.props)])
            self.props[len(at)] = self._row(t)
            at[t] = len(at)
        p = self.props[np.fromiter(map(at.__getitem__, tokens), np.int64, m)]
        hit = (p[:, 0] > 0) | (p[:, 1] > 0) | (p[:, 2] > 0)
        where, second = np.flatnonzero(hit), np.flatnonzero(p[:, 3] > 0)
        near = 0.0
        if len(where) and len(second):
            i = np.searchsorted(second, where)
            gap = np.minimum(np.abs(second[np.minimum(i, len(second) - 1)] - where), np.abs(where - second[np.maximum(i - 1, 0)]))
            near = float(1 / (1 + gap.min()))
        n = len(text)
        word, start, hidden = p[:, 0] > 0, p[:, 1] > 0, p[:, 2] > 0
        return [
            math.log1p(m), float(word.sum()), float(word.mean()), float(p[:, 0].sum()) / m, float(p[:, 0].max()),
            float(len(np.unique(p[word, 0]))), float(start.sum()), float(start.mean()), float(p[:, 1].max()),
            float((word | start).sum()), near, float(second.size) / m, float(p[:, 4].mean()), text.count("!") / n,
            (text.count("?") + text.count("*") + text.count("#")) / n, float(hidden.sum()), float(hidden.mean()), float(p[:, 5].mean()),
        ]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log-odds of the terms that are surely more usual in toxic documents; equal texts count once.

    A term passes if so many toxic documents among those that hold it would be expected at most
    ``FALSE_TERMS`` times among all terms tested, were it unrelated to the label (Chernoff bound
    of the binomial tail), and if its log-odds reach ``LEAST_ODDS``.
    """
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("toxic", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                n: Counter = Counter()
                toxic: Counter = Counter()
                for t, y in zip(texts, part.column(part.schema.get_field_index("y")).to_pylist(), strict=True):
                    found = terms(t)
                    n.update(found)
                    n[""] += 1  # the document itself
                    if y:
                        toxic.update(found)
                        toxic[""] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array([toxic[t] for t in n], pa.int64()),
                                                  pa.array(list(n.values()), pa.int64())], names=schema.names)

    once = sample.groupBy("text").agg(F.max("y").alias("y"))
    sums = cut(once.select("text", "y").mapInArrow(run, schema).groupBy("term")
               .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where(f"toxic >= {LEAST_DOCS} or term = ''"))
    whole = sums.where("term = ''").first()
    if whole is None or not whole.toxic or whole.toxic == whole.n:
        return {}
    t, f = whole.toxic, whole.n - whole.toxic
    share, base = F.col("toxic") / F.col("n"), t / (t + f)
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    bound = F.col("n") * (share * F.log(share / base) + rest)  # -ln of the tail
    odds = F.log((F.col("toxic") + 0.1) / (t + 0.2)) - F.log((F.col("n") - F.col("toxic") + 0.1) / (f + 0.2))
    tested = math.log(max(1, sums.count() / FALSE_TERMS))
    rows = (sums.where("term <> ''").withColumn("odds", odds)
            .where((share > base) & (bound >= tested) & (F.col("odds") >= LEAST_ODDS)).collect())
    return {r.term: float(r.odds) for r in rows}


def _with_features(df: DataFrame, odds: dict[str, float], text_col: str, keep: list[str]) -> DataFrame:
    sent = send(df.sparkSession, odds)

    def make():
        lexicon = received(sent, Lexicon)
        return lambda texts: [[lexicon.features(t) for t in texts], [bool(t) for t in texts]]

    fields = [T.StructField("__x", T.ArrayType(T.DoubleType(), False)), T.StructField("__some", T.BooleanType())]
    return append_columns(df, text_col, make, fields, keep)


class Model:
    """Lexicon, trees, calibration and base rate."""

    def __init__(self, odds: dict[str, float], trees: GBTClassificationModel | None, points, base: float):
        self.odds, self.trees, self.points, self.base = odds, trees, points, base


def _margins(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    out = trees.transform(df.withColumn("features", array_to_vector("__x")))
    return out.withColumn("__s", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Learns lexicon and trees on three quarters of the sample, by a hash of the id; calibrates on the rest."""
    sample = labelled_sample(docs, labels, label_col, train, id_col, text_col, rows).where("text <> ''")
    sample = cut(sample.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(13)), F.lit(4))))
    n = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).first()
    base = n.y / n.n if n.n else 0.5
    odds = learn_lexicon(sample.where("fold > 0"))
    x = cut(_with_features(sample, odds, "text", ["id", "y", "fold"]))
    fitted = x.where("fold > 0").withColumn("features", array_to_vector("__x"))
    if fitted.select("y").distinct().count() < 2:
        return Model(odds, None, None, base)
    trees = GBTClassifier(labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(fitted.select("features", "y"))
    scored = _margins(trees, x).withColumn("b", F.round("__s", 3))
    bins = (scored.groupBy(F.col("fold") == 0, "b").agg(F.avg("__s").alias("s"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n"))
            .toDF("left_out", "b", "s", "y", "n").toPandas())
    seen = bins[bins["left_out"]]
    if seen.empty or not 0 < float((seen["y"] * seen["n"]).sum()) < float(seen["n"].sum()):
        seen = bins  # too small a sample to leave rows out
    return Model(odds, trees, isotonic(*(seen[c].to_numpy(float) for c in ("s", "y", "n"))), base)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the calibrated score of each whole text."""
    names = [c for c in (docs.columns if keep is None else keep) if c != out]
    x = _with_features(docs, model.odds, text_col, names)
    if model.trees is None:
        return x.withColumn(out, F.lit(float(model.base))).select(*names, out)
    points = model.points

    @F.pandas_udf("double")
    def calibrated(s: pd.Series) -> pd.Series:
        return pd.Series(calibrate(points, s.to_numpy()))

    s = F.when(F.col("__some"), calibrated("__s")).otherwise(F.lit(float(model.base)))
    return _margins(model.trees, x).withColumn(out, s).select(*names, out)
