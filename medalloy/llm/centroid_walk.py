"""Centroid clustering of integer vectors; nearest centroids by the threshold algorithm.

Each dimension has the centroids sorted by their value there. From a vector's value the list is
walked outward, the nearer side first, in all dimensions at once. A centroid is measured when it
is first met. The frontier distance of a dimension is the one to the next value of its walk; an
unmet centroid is at least as far in every dimension, so the walk ends when the sum of the
squared frontier distances strictly exceeds the best exact distance (ties go to the smaller
number, so equal sums go on).

Vectors stay where they are: each round is one pass over the vectors that sends a count and
component sums per centroid and task, which Spark adds; only ``k`` sums of ``dims`` numbers reach
the driver.

Defined results: vectors that are null, of another length than ``dims``, or that hold a null or
non-finite component take no part, nor do those with a component of 2**26 or more as an
integer (their squared distance would leave a long); repeated rows are vectors of their own; null
ids start a centroid only if there are too few others; equal ids start centroids in the order
of their components; with fewer vectors than ``k`` there are fewer centroids; no vectors, no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalloy.llm.common import col, cut

LARGEST = 2 ** 26
CHUNK = 4096


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as a double, for vectors that take part."""
    whole = rows.select(col(id_col).cast("long").alias("vec_id"), col(vec_col).cast("array<double>").alias("x")).where(F.size("x") == dims)
    v = whole.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"), "x")
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    large = F.exists("v", lambda c: (c >= LARGEST) | (c <= -LARGEST))
    return v.where(~F.coalesce(bad, F.lit(True))).where(~large).select("vec_id", "v")


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``salt`` and id, in that order."""
    h = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


class SortedLists:
    """The centroids sorted by each dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable")
        self.number = order.T.copy()  # (dims, k)
        self.value = np.take_along_axis(centroids, order, axis=0).T.copy()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of each row's nearest centroid, and the distances measured."""
        n, dims = x.shape
        k = len(self.centroids)
        high = np.empty((n, dims), np.int64)  # next place to the right; to the left it is low
        for d in range(dims):
            high[:, d] = np.searchsorted(self.value[d], x[:, d])
        low = high - 1
        met = np.zeros((n, k), bool)
        best, number = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        active, across, measured = np.arange(n), np.arange(dims)[None, :], 0
        far = np.int64(np.iinfo(np.int64).max)
        while len(active):
            own, lo, hi = x[active], low[active], high[active]
            down = np.where(lo >= 0, own - self.value[across, np.maximum(lo, 0)], far)
            up = np.where(hi < k, self.value[across, np.minimum(hi, k - 1)] - own, far)
            left = down <= up
            name = self.number[across, np.where(left, np.maximum(lo, 0), np.minimum(hi, k - 1))]
            seen = met[active]
            before = seen.copy()
            np.put_along_axis(seen, name, True, axis=1)
            met[active] = seen
            row, c = np.nonzero(seen & ~before)
            measured += len(row)
            gap = own[row] - self.centroids[c]
            got = np.full((len(active), k), far)
            got[row, c] = (gap * gap).sum(1)
            nearest = got.argmin(1)  # the smallest number among equals
            exact = got[np.arange(len(active)), nearest]
            better = (exact < best[active]) | ((exact == best[active]) & (nearest < number[active]))
            number[active] = np.where(better, nearest, number[active])
            best[active] = np.minimum(best[active], exact)
            lo, hi = lo - left, hi + ~left
            low[active], high[active] = lo, hi
            down = np.where(lo >= 0, own - self.value[across, np.maximum(lo, 0)], far)
            up = np.where(hi < k, self.value[across, np.minimum(hi, k - 1)] - own, far)
            front = np.minimum(down, up)
            over = (front == far).any(1)  # a list that is used up has met every centroid
            front = np.where(front == far, 0, front)
            active = active[~over & ((front * front).sum(1) <= best[active])]
        return number, best, measured


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """count and component sums of each centroid's vectors."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, count, total = SortedLists(centroids), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)

        def told() -> pa.RecordBatch:
            has = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(count[has]), pa.array(total[has].tolist(), pa.list_(pa.int64()))],
                                              names=["c", "n", "s"])

        for _, x in _chunks(batches, dims):
            number = lists.nearest(x)[0]
            count += np.bincount(number, minlength=k)
            np.add.at(total, number, x)
            if count.sum() > 2 ** 36:  # sums of so many components below 2**26 stay in a long
                yield told()
                count[:], total[:] = 0, 0
        if count.any():
            yield told()

    part = vectors.mapInArrow(run, "c int, n long, s array<long>")
    wide = F.col("s").cast("array<decimal(38,0)>")
    sums = part.select("c", F.col("n").cast("decimal(38,0)").alias("n"), F.posexplode(wide).alias("d", "x")) \
        .groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums.collect():  # k x dims numbers
        out.setdefault(r["c"], (int(r["n"]), [0] * dims))[1][r["d"]] = int(r["x"])
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, salt: str = "1:") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` of assignment and exact floor means, and one more assignment.

    ``vectors`` as :func:`integer_vectors` gives them; empty centroids stay where they are.
    """
    centroids = first_centroids(vectors, k, salt)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    dims = centroids.shape[1]
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, s) in _sums(vectors, centroids).items():
            moved[c] = [x // n for x in s]
        centroids = moved
    last = centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(last)
        for ids, x in _chunks(batches, dims):
            number, best, _ = lists.nearest(x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(assign, schema), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and the digest of the own centroid (k rows are joined)."""
    rows = cut(assigned)
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    total = sum(int(r["s"]) for r in per)
    known = [(r["cluster"], int(r["s"]), total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in per]
    about = rows.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


CLUSTER_SQL = """
with recursive kept as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
seed as (
  select (row_number() over (order by sha256('1:' || vec_id), v) - 1)::int as c, v from kept
  qualify c < 16),
steps as (
  select 0 as step, c, v from seed
  union all
  (with near as (
     select r.r, r.v, arg_min(s.c, (list_sum(list_transform(list_zip(r.v, s.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), s.c)) as c
     from kept r, steps s where s.step < 3 group by r.r, r.v),
   part as (select c, i, sum(v[i]) as x, count(*) as n from near, range(1, 65) t(i) group by c, i),
   mean as (select c, list(((x - ((x % n) + n) % n) // n)::bigint order by i) as v from part group by c)
   select s.step + 1, s.c, coalesce(m.v, s.v) from steps s left join mean m on m.c = s.c where s.step < 3)),
final as (
  select r.vec_id, arg_min(s.c, (list_sum(list_transform(list_zip(r.v, s.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), s.c)) as cluster,
    min(list_sum(list_transform(list_zip(r.v, s.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))::bigint as distance
  from kept r, steps s where s.step = 3 group by r.r, r.vec_id)
select f.vec_id, f.cluster::int as cluster, f.distance, sum(f.distance) over (partition by f.cluster)::bigint as cluster_inertia,
  sum(f.distance) over ()::bigint as inertia, sha256(array_to_string(s.v, ',')) as centroid_sha256
from final f join steps s on s.step = 3 and s.c = f.cluster"""
