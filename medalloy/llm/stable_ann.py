"""Approximate nearest neighbours: 2-stable projections, kd-trees, chi-square stopping test.

Vectors are projected to a few dimensions by a Gaussian matrix. For a vector at distance ``d``
the squared projected distance over ``d**2`` follows a chi-square law with as many degrees of
freedom. A search takes projected neighbours by rising projected distance from a kd-tree, verifies
them on the whole vectors, and stops when the law says that a vector as near as the present k-th
best would have been met already with the asked confidence.

On Spark the top of the kd-tree, split at medians of a bounded sample, deals all vectors to cells
(``MAX_CELLS`` at most); a cell of more than ``BLOCK`` vectors is dealt to several blocks by hash,
and each block builds its own kd-tree when it is met. A query first searches the block where it lies
itself, which bounds its k-th best distance, then the blocks of all cells that the stopping test
doesn't rule out. The cells' boxes are the only data sent to all tasks, and bounded.

Equal vectors are one point: of its ids the ``k + 1`` smallest go on (no query needs more), and
queries with equal vectors are searched once. So a vector that a third of all rows share is no
hot group.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component take no
part; vectors of another length than the query's are not compared with it; null ids are candidates,
never queries, and come last among ties; rows with the query's id are no candidates; rows that
repeat an id and a vector are candidates of their own, but one query; an id with several vectors has
an answer for each; ties go to the smaller id; no rows, no rows out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalloy.llm.common import col, cut

DIMS = 8
CONFIDENCE = 0.98
BLOCK = 8192
QUERY_BLOCK = 16_384
LEAF = 256
SAMPLE = 16_384
MAX_CELLS = 4096
NULL_ID = np.iinfo(np.int64).max  # stands for a null id inside blocks: last among ties


def chi_square_cdf(x: np.ndarray | float, dims: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for j in range(1, dims // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_bound(confidence: float, dims: int) -> float:
    """Where the distribution function reaches ``confidence``."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < confidence:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < confidence else (low, mid)
    return high


def projection(length: int, dims: int = DIMS) -> np.ndarray:
    """The (length, dims) Gaussian matrix, the same in every task."""
    return np.random.default_rng([length, dims, 11]).standard_normal((length, dims))


class KdTree:
    """Median splits on the widest dimension down to leaves; boxes of all nodes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.order = np.arange(len(points))
        self.span: list[tuple[int, int]] = []
        self.kids: list[tuple[int, int] | None] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        todo = [(0, len(points), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            here = len(self.span)
            own = points[self.order[a:b]]
            low, high = (own.min(0), own.max(0)) if b > a else (np.zeros(points.shape[1]),) * 2
            self.span.append((a, b))
            self.kids.append(None)
            self.low.append(low)
            self.high.append(high)
            if parent >= 0:
                two = self.kids[parent] or (-1, -1)
                self.kids[parent] = (here, two[1]) if side == 0 else (two[0], here)
            wide = int((high - low).argmax())
            if b - a > leaf and high[wide] > low[wide]:
                mid = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, wide], mid)]
                todo += [(a, a + mid, here, 0), (a + mid, b, here, 1)]

    def rising(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared frontier distance, positions of a leaf): leaves by rising distance of their boxes from ``q``."""
        heap = [(0.0, 0)] if len(self.points) else []
        while heap:
            d, node = heapq.heappop(heap)
            if self.kids[node] is None:
                a, b = self.span[node]
                yield d, self.order[a:b]
            else:
                for kid in self.kids[node]:
                    gap = np.maximum(np.maximum(self.low[kid] - q, q - self.high[kid]), 0)
                    heapq.heappush(heap, (max(d, float(gap @ gap)), kid))


def box_distances(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low[None] - q[:, None], q[:, None] - high[None]), 0)
    return (gap * gap).sum(2)


class Best:
    """The best candidates by (distance, id): at most k of one id, enough that k stay without any one id."""

    def __init__(self, k: int):
        self.k = k
        self.d, self.ids, self.n = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)
        self.reach = math.inf  # distance of the k-th candidate, whichever id is the query's

    def add(self, d: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        d, ids, n = np.concatenate([self.d, d]), np.concatenate([self.ids, ids]), np.concatenate([self.n, n])
        order = np.lexsort((ids, d))
        took: dict[int, int] = {}
        keep, total = [], 0
        self.reach = math.inf
        for i in order.tolist():
            at = int(ids[i])
            more = min(int(n[i]), self.k - took.get(at, 0))
            if more > 0:
                took[at] = took.get(at, 0) + more
                total += more
                keep.append(i)
                if total - max(took.values()) >= self.k:
                    self.reach = float(d[i])
                    break
        self.d, self.ids, self.n = d[keep], ids[keep], n[keep]


def search(q: np.ndarray, qp: np.ndarray, tree: KdTree, vectors: np.ndarray, ids: np.ndarray, n: np.ndarray, k: int,
           bound: float, reach: float = math.inf) -> tuple[Best, int]:
    """The best of a block for one query, and the candidates verified.

    ``reach`` is a distance within which the query has its k neighbours elsewhere. Projected
    neighbours are verified while the squared frontier is at most ``bound`` times the squared
    k-th distance: beyond it, the chi-square law gives the asked confidence.
    """
    best, made = Best(k), 0
    slack = 1e-9 * (1.0 + float(qp @ qp))  # products of other shapes differ in their last bits
    for front, at in tree.rising(qp):
        stop = bound * min(best.reach, reach) ** 2 + slack
        if front > stop:
            break
        gap = tree.points[at] - qp
        at = at[(gap * gap).sum(1) <= stop]
        made += len(at)
        d = np.sqrt(((vectors[at] - q) ** 2).sum(1))
        near = d <= min(best.reach, reach)
        if near.any():
            best.add(d[near], ids[at][near], n[at][near])
    return best, made


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v, h1, h2): vectors that take part, with a key of 128 bits for equal ones."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    own = rows.select(col(id_col).cast("long").alias("vec_id"), col(vec_col).cast("array<double>").alias("v")).where(F.size("v") > 0)
    own = own.where(~F.coalesce(bad, F.lit(True))).where(F.exists("v", lambda x: x != 0))
    own = own.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))  # one zero
    return own.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), F.reverse("v"))})


class Cells:
    """Top of the kd-tree over a sample, for each length of vectors: split planes only, so every vector has a cell."""

    def __init__(self, samples: dict[int, np.ndarray], wanted: int, dims: int):
        self.dims, self.splits = dims, {}
        for length, x in samples.items():
            nodes: list[tuple[int, float, int, int]] = []  # dimension, value, kids; a leaf is (-1, 0, cell, 0)
            cells = 0
            todo = [(x @ projection(length, dims), max(1, wanted), -1, 0)]
            while todo:
                p, want, parent, side = todo.pop()
                here = len(nodes)
                if parent >= 0:
                    a = list(nodes[parent])
                    a[2 + side] = here
                    nodes[parent] = tuple(a)
                wide = int((p.max(0) - p.min(0)).argmax()) if len(p) else 0
                cutoff = float(np.median(p[:, wide])) if len(p) else 0.0
                right = p[:, wide] > cutoff if len(p) else np.zeros(0, bool)
                if want < 2 or not right.any() or right.all():
                    nodes.append((-1, 0.0, cells, 0))
                    cells += 1
                else:
                    nodes.append((wide, cutoff, 0, 0))
                    todo += [(p[~right], want // 2, here, 0), (p[right], want - want // 2, here, 1)]
            self.splits[length] = nodes

    def of(self, p: np.ndarray, length: int) -> np.ndarray:
        nodes, out = self.splits.get(length, [(-1, 0.0, 0, 0)]), np.zeros(len(p), np.int32)
        todo = [(0, np.arange(len(p)))]
        while todo:
            node, at = todo.pop()
            wide, cutoff, left, right = nodes[node]
            if wide < 0:
                out[at] = left
            else:
                over = p[at, wide] > cutoff
                todo += [(left, at[~over]), (right, at[over])]
        return out


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _by_length(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch.column(name).offsets.to_numpy())
    for length in np.unique(sizes).tolist():
        yield length, batch.filter(pa.array(sizes == length))


def _deal(points: DataFrame, cells: Cells, dims: int) -> DataFrame:
    """``points`` with their length ``nv``, projection ``p`` and ``cell``."""
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, part in _by_length(batch, "v"):
                p = _matrix(part.column("v"), length) @ projection(length, dims)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * dims, pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(p), length, np.int32)), lists, pa.array(cells.of(p, length))],
                                                 names=[*names, "nv", "p", "cell"])

    kinds = ", ".join(f"{n} {t}" for n, t in points.dtypes)
    return points.mapInArrow(run, f"{kinds}, nv int, p array<double>, cell int")


def neighbours(queries: DataFrame, rows: DataFrame, k: int = 10, dims: int = DIMS, confidence: float = CONFIDENCE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of ``rows`` found for each of ``queries``.

    Both as :func:`valid_vectors` gives them. ``dims`` must be even. Each true neighbour is met with
    a probability of ``confidence`` or more.
    """
    bound = chi_square_bound(confidence, dims)
    counted = rows.groupBy("h1", "h2", "v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("n"))
    smallest = Window.partitionBy("h1", "h2").orderBy(F.col("vec_id").asc_nulls_last())
    points = counted.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).drop("r")
    total = rows.count()
    share = F.pmod(F.col("h1"), F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, SAMPLE / max(total, 1)))
    near = rows.where(share).select("v").limit(2 * SAMPLE).toPandas()["v"]  # at most 2 * SAMPLE vectors
    samples: dict[int, list] = {}
    for v in near:
        samples.setdefault(len(v), []).append(v)
    cells = Cells({n: np.array(x, float) for n, x in samples.items()}, min(MAX_CELLS, math.ceil(total / block)), dims)
    placed = cut(_deal(points, cells, dims))
    ranges = placed.groupBy("nv", "cell").agg(F.count(F.lit(1)).alias("n"), *(F.min(F.col("p")[i]).alias(f"l{i}") for i in range(dims)),
                                              *(F.max(F.col("p")[i]).alias(f"u{i}") for i in range(dims)))
    boxes: dict[int, list] = {}
    for r in ranges.collect():  # a row for each cell
        boxes.setdefault(r["nv"], []).append((r["cell"], math.ceil(r["n"] / block), [r[f"l{i}"] for i in range(dims)], [r[f"u{i}"] for i in range(dims)]))
    return _answers(queries, _searched(queries, placed, boxes, cells, k, dims, bound, block), k)


def _searched(queries: DataFrame, placed: DataFrame, boxes: dict[int, list], cells: Cells, k: int, dims: int, bound: float,
              block: int) -> DataFrame:
    """(h1, h2, score, vec_id, n) of the best of each block that a query's search meets."""
    spark = placed.sparkSession
    sizes = F.broadcast(spark.createDataFrame([(nv, cell, parts) for nv, own in boxes.items() for cell, parts, _, _ in own],
                                              "nv int, cell int, parts int"))  # a row for each cell
    asked = cut(_deal(queries.select("h1", "h2", "v").dropDuplicates(["h1", "h2"]), cells, dims))
    q_parts = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    own_part, own_sub = F.pmod("h1", F.lit(q_parts)).cast("int"), F.pmod("h2", "parts").cast("int")
    blocks = placed.join(sizes, ["nv", "cell"]).select("nv", "cell", F.pmod(F.xxhash64("h2", "vec_id"), "parts").cast("int").alias("sub"),
                                                       F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))).alias("part"),
                                                       F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), "v", "p", "n")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        made: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            length = left["nv"][0].as_py()
            v, p = (_matrix(right[c].combine_chunks(), w) for c, w in (("v", length), ("p", dims)))
            q, qp = (_matrix(left[c].combine_chunks(), w) for c, w in (("v", length), ("p", dims)))
            tree, ids, n = KdTree(p), right["vec_id"].to_numpy(), right["n"].to_numpy()
            h1, h2, reach = (left[c].to_numpy() for c in ("h1", "h2", "reach"))
            for i in range(len(q)):
                best, _ = search(q[i], qp[i], tree, v, ids, n, k, bound, float(reach[i]))
                m = len(best.d)
                made.append((np.full(m, h1[i]), np.full(m, h2[i]), best.d, best.ids, best.n, np.full(m, best.reach)))
        kinds = (np.int64, np.int64, np.float64, np.int64, np.int64, np.float64)
        columns = [np.concatenate(x) for x in zip(*made, strict=True)] if made else [np.empty(0, t) for t in kinds]
        return pa.table([pa.array(np.asarray(c, t)) for c, t in zip(columns, kinds, strict=True)], names=["h1", "h2", "score", "vec_id", "n", "reach"])

    def met(visits: DataFrame) -> DataFrame:
        keys = ["nv", "cell", "sub", "part"]
        return visits.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(meet, "h1 long, h2 long, score double, vec_id long, n long, reach double")

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and each cell whose box the stopping test doesn't rule out."""
        for batch in batches:
            for length, part in _by_length(batch, "v"):
                if length not in boxes:
                    continue
                p, reach = _matrix(part.column("p"), dims), part.column("reach").to_numpy(zero_copy_only=False)
                far = box_distances(p, np.array([b[2] for b in boxes[length]]), np.array([b[3] for b in boxes[length]]))
                stop = bound * reach ** 2 + 1e-9 * (1 + (p * p).sum(1))
                row, box = np.nonzero(far <= stop[:, None])
                names = np.array([b[0] for b in boxes[length]], np.int32)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(names[box])], names=[*part.schema.names, "cell"])

    far_off = F.lit(math.inf)
    home = asked.join(sizes, ["nv", "cell"]).select("h1", "h2", "v", "p", "nv", "cell", own_sub.alias("sub"), own_part.alias("part"), far_off.alias("reach"))
    first = cut(met(home))
    known = first.groupBy("h1", "h2").agg(F.min("reach").alias("reach"))
    again = asked.join(known, ["h1", "h2"], "left").select("h1", "h2", "v", "p", "nv", F.col("cell").alias("own"), F.coalesce("reach", far_off).alias("reach"))
    schema = "h1 long, h2 long, v array<double>, p array<double>, nv int, own int, reach double, cell int"
    visits = again.mapInArrow(reached, schema).join(sizes, ["nv", "cell"]).select(
        "h1", "h2", "v", "p", "nv", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sub"), own_part.alias("part"), "reach", "own",
        own_sub.alias("own_sub")).where((F.col("cell") != F.col("own")) | (F.col("sub") != F.col("own_sub"))).drop("own", "own_sub")
    both = first.unionByName(met(visits))
    return both.select("h1", "h2", "score", F.when(F.col("vec_id") != NULL_ID, F.col("vec_id")).alias("vec_id"), "n")


def _answers(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best for each query id; windows are cut to few rows a group before they are shuffled."""
    nearest = ["score", F.col("vec_id").asc_nulls_last()]
    few = found.withColumn("r", F.row_number().over(Window.partitionBy("h1", "h2", "vec_id").orderBy("score"))).where(F.col("r") <= k).drop("r")
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("h1", "h2").orderBy(*nearest))).where(F.col("r") <= 2 * k).drop("r")
    asked = queries.where("vec_id is not null").select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    rows = asked.join(few, ["h1", "h2"]).where(~F.col("vec_id").eqNullSafe(F.col("query_id")))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id", "h1", "h2").orderBy(*nearest)))
    return rows.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
