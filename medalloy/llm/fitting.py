"""Shared parts of the trained scores: labelled sample and isotonic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.llm.common import col, crc_mod, sampled
from medalloy.operators.sizing import broadcast_if_small

SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, id_col: str = "doc_id",
                    text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, text, y) of about ``rows`` labelled documents at most, picked by a hash of the id.

    ``train`` is a condition on the column ``id``. Repeated labels of a document are joined by
    their mean, a tie counting as 1; documents without a label or text take no part.
    """
    y = (labels.select(col(id_col).alias("id"), col(label_col).cast("double").alias("y")).where("id is not null and y is not null")
         .where(train).groupBy("id").agg((F.avg("y") >= 0.5).cast("double").alias("y")))
    few = sampled(y, rows, F.col("id"), y.count())
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).where("text is not null")
    return texts.join(broadcast_if_small(few), "id")


def isotonic(scores: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: rising scores and calibrated shares between which to interpolate.

    A share is drawn towards the base rate by one pseudo-row, so that it is never 0 or 1 by chance.
    """
    if not len(scores):
        return np.array([0.0]), np.array([0.5])
    order = np.argsort(scores, kind="stable")
    base = float((y * w).sum() / w.sum())
    parts: list[list[float]] = []  # weight, weighted label, weighted score
    for s, t, n in zip(scores[order], y[order], w[order], strict=True):
        parts.append([n, n * t, n * s])
        while len(parts) > 1 and parts[-2][1] * parts[-1][0] >= parts[-1][1] * parts[-2][0]:
            last = parts.pop()
            parts[-1] = [a + b for a, b in zip(parts[-1], last, strict=True)]
    x = np.array([p[2] / p[0] for p in parts])
    return x, np.array([(p[1] + base) / (p[0] + 1) for p in parts])


def calibrate(points: tuple[np.ndarray, np.ndarray], scores: np.ndarray) -> np.ndarray:
    return np.clip(np.interp(scores, *points), 0.0, 1.0)


def held_out(id_col: str, m: int, r: int) -> Column:
    return crc_mod(col(id_col), m) == r
