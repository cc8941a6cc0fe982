"""Exact top-k inner-product search by pivot-table elimination, in blocks.

For integer vectors, ``q . c = (|q|^2 + |c|^2 - d(q, c)^2) / 2``, and every pivot ``p`` gives the
lower bound ``|d(q, p) - d(c, p)| <= d(q, c)``. The largest bound over many pivots therefore
caps the score. In a block, each query takes its candidates by falling cap and stops as soon
as the cap of the next ones is below its k-th best score so far; what it evaluates is exact.

Queries and candidates are dealt out in blocks of bounded size: a candidate block meets every
query block once (a stated query set against all rows). Each meeting returns k rows a query;
these are ranked per query by a window, which keeps k rows a task before they are shuffled and never
holds a query's rows of all blocks in one buffer. Rows that repeat an id and a vector are counted before
they are dealt out (up to k, more are never needed), so that none of them makes a hot block.

Defined results: vectors that are null, empty or hold a null or non-finite component take no
part, as queries or candidates; vectors of another length than the query's are not compared
with it; every row is a candidate of its own, also one that repeats another or has no id; a query
row that repeats another is one query, and queries that share an id have one answer, the k best
rows of all its vectors; an own id is no candidate; no rows in, no rows out. Ties go to the smaller
``vec_id``, null last; a null id is no query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalloy.llm.common import col

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 1024
PIVOTS = 32
PIVOT_SAMPLE = 2000
CHUNK = 512
NULL_ID = np.iinfo(np.int64).max  # stands for a null id inside blocks: last among ties


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, v, nv): floor(scale * x) as integers, for vectors that take part."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return (rows.select(col(id_col).cast("long").alias("vec_id"), col(vec_col).cast("array<double>").alias("v"))
            .where("v is not null").where((F.size("v") > 0) & ~bad)
            .select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))
            .withColumn("nv", F.size("v")))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots of a bounded sample."""
    if not len(sample):
        return sample
    at = [int(np.argmax((sample ** 2).sum(1)))]
    far = ((sample - sample[at[0]]) ** 2).sum(1)
    while len(at) < min(n, len(sample)) and far.max() > 0:
        at.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[at[-1]]) ** 2).sum(1))
    return sample[at]


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(d, 0))


def search_block(qi: np.ndarray, q: np.ndarray, ci: np.ndarray, c: np.ndarray, pivots: np.ndarray, k: int
                 ) -> tuple[list[tuple[int, int, int, int]], int]:
    """(query position, query id, vec_id, score) of the k best of a block, and the evaluations made.

    Components are integers; products and sums stay exact in float64 below 2**53.
    """
    qd, cd = distances(q, pivots), distances(c, pivots)
    qn, cn = (q * q).sum(1), (c * c).sum(1)
    out, made = [], 0
    for i in range(len(q)):
        low = np.zeros(len(c))
        for p in range(len(pivots)):
            np.maximum(low, np.abs(cd[:, p] - qd[i, p]), out=low)
        cap = (qn[i] + cn - low * low) / 2 + 1e-6 * (1 + qn[i] + cn)  # slack for rounded distances
        cap[ci == qi[i]] = -np.inf
        order = np.argsort(-cap)
        ids, scores = np.empty(0, np.int64), np.empty(0)
        for at in range(0, len(order), CHUNK):
            take = order[at:at + CHUNK]
            take = take[cap[take] > -np.inf]
            if not len(take) or (len(scores) == k and cap[take[0]] < scores[-1]):
                break
            made += len(take)
            ids, scores = np.concatenate([ids, ci[take]]), np.concatenate([scores, c[take] @ q[i]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        out += [(i, int(qi[i]), int(a), int(b)) for a, b in zip(ids, scores, strict=True)]
    return out, made


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score); both inputs as :func:`integer_vectors` gives them."""
    rows = rows.groupBy(F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), "v", "nv").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("n"))
    queries = queries.where("vec_id is not null").select("vec_id", "v", "nv").distinct()
    n_rows, n_queries = rows.count(), queries.count()
    groups, blocks = max(1, math.ceil(n_rows / CANDIDATE_BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))
    share = min(1.0, PIVOT_SAMPLE / max(n_rows, 1))
    near = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_000)) < math.ceil(1e6 * share)) \
        .select("nv", "v").limit(2 * PIVOT_SAMPLE).toPandas()
    chosen = {int(n): choose_pivots(np.array(g["v"].tolist(), float), pivots) for n, g in near.groupby("nv")}

    def deal(df: DataFrame, parts: int, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int"))

    cand = deal(rows, groups, "g").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = deal(queries, blocks, "b").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for n, own in left.groupby("nv"):
            other = right[right["nv"] == n]
            other = other.loc[other.index.repeat(other["n"])]  # at most k rows of an id and vector
            if not len(other):
                continue
            q, c = np.array(own["v"].tolist(), float), np.array(other["v"].tolist(), float)
            got, _ = search_block(own["vec_id"].to_numpy(), q, other["vec_id"].to_numpy(), c, chosen.get(int(n), c[:pivots]), k)
            parts.append(pd.DataFrame([g[1:] for g in got], columns=["query_id", "vec_id", "score"]))
        if not parts:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(parts)

    met = (asked.groupBy("g", "b").cogroup(cand.groupBy("g", "b"))
           .applyInPandas(meet, "query_id long, vec_id long, score long"))
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.when(F.col("vec_id") != NULL_ID, F.col("vec_id")).alias("vec_id"), "score")
