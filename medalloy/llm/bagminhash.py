"""Near-duplicate detection: BagMinHash signatures, banding, exact check of multiset overlap.

Each (shingle, weight level) emits a Poisson process in time, with a rate as large as the
level's span of weights (levels 0-1, 1-2, 2-4, 4-8, ...); a point carries a slot and a weight
position, and counts if the position lies below the shingle's weight in the document. So any
two documents see the same points up to the smaller of their weights, and the first point of
each slot is shared with probability equal to the weighted Jaccard similarity (sum of least
over sum of greatest counts). Points are made in time order and only up to a bound that fills
all slots; a shingle whose first point lies beyond it costs one hash.

Links are pairs of different texts of similarity 0.8 or more on five-word shingles. They are
found without expanding a group of copies into its pairs:

1. texts with the same words are one copy class, held by its smallest id;
2. classes that share a band form a bucket; each is checked against the bucket's leader (the
   class that shares most buckets), and the links found give components;
3. where a bucket still spans several components, each member is reduced to its difference
   from the leader. With s = |A| + |B|, a link A-B needs |difference of differences| <= s/9,
   hence many common difference elements; a prefix filter per pair of difference sizes gives
   the pairs to check. Members that link to the leader are in one component already, so only
   pairs with another member, of other components, are made, each under the first leader that
   both members have.

Defined results: a null text, or one without a word, is a class of its own and links to
nothing; a text of fewer than five words is one shingle; rows of equal words are one class;
rows that repeat a ``doc_id`` are told apart by their class only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, col, components, cut, mix64, slices
from medalloy.llm.shingles import multiset, overlap, shingle_hashes, word_hashes

BANDS, ROWS = 24, 6  # a pair of similarity 0.8 shares a band with probability 0.9993
THRESHOLD = 0.8
HOT_NODES = 4_096
_G = np.uint64(0x9E3779B97F4A7C15)


def _times(i: int) -> np.uint64:
    return np.uint64(i * int(_G) & 0xFFFFFFFFFFFFFFFF)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """BagMinHash signature (first time per slot) of each non-empty multiset: (len(sets), m)."""
    sig = np.full((len(sets), m), np.inf)
    if not sets:
        return sig
    sizes = np.array([len(x) for x, _ in sets])
    weight = np.array([int(c.sum()) for _, c in sets], float)
    x, c = np.concatenate([x for x, _ in sets]), np.concatenate([c for _, c in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    until = m / weight * (math.log(m) + 3)
    todo = np.ones(len(sets), bool)
    while todo.any():
        use = todo[doc]
        _first_points(x[use], c[use], doc[use], until, m, sig)
        todo = (sig > until[:, None]).any(1)  # a slot without a point before the bound
        until[todo] *= 2
        sig[todo] = np.inf
    return sig


def _first_points(x: np.ndarray, c: np.ndarray, doc: np.ndarray, until: np.ndarray, m: int, sig: np.ndarray) -> None:
    flat = sig.reshape(-1)
    level = low = 0
    span = 1
    while len(x):
        seed = mix64(x + _times(level + 1))
        time = np.zeros(len(x))
        d, w = doc, c
        step = 1
        while len(seed):
            h = mix64(seed + _times(step))
            u = ((h >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
            time = time - np.log(u) / span
            on = time < until[d]
            seed, time, d, w, h = seed[on], time[on], d[on], w[on], h[on]
            p = mix64(h ^ _G)
            slot = ((p >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            key, at = d * m + slot.astype(np.int64), time
            if level:
                below = low + (p & np.uint64(0xFFFFFFFF)).astype(float) * 2.0 ** -32 * span < w
                key, at = key[below], at[below]
            np.minimum.at(flat, key, at)
            step += 1
        low, span, level = low + span, max(1, low + span), level + 1
        keep = c > low
        x, c, doc = x[keep], c[keep], doc[keep]


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, of the times of its slots and its number."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _G, (len(sig), bands))
    for i in range(rows):
        key = mix64(key + bits[:, :, i])
    return key.view(np.int64)


SIGNED = [T.StructField("node", T.BinaryType()), T.StructField("n", T.LongType()),
          T.StructField("keys", T.ArrayType(T.LongType(), False))]


def _sign() -> object:
    """Class key (128-bit hash of the words), shingle count and band keys of each text."""
    def run(texts: list[str]) -> list:
        words, keys, n = [None] * len(texts), [None] * len(texts), [0] * len(texts)
        at, sets = [], []
        for i, t in enumerate(texts):
            w = word_hashes(t)
            if len(w):
                words[i] = xxhash.xxh3_128_digest(w.tobytes())
                s = np.unique(shingle_hashes(w), return_counts=True)
                n[i] = int(s[1].sum())
                at.append(i)
                sets.append(s)
        for i, k in zip(at, band_keys(signatures(sets, BANDS * ROWS)).tolist() if at else [], strict=True):
            keys[i] = k
        return [words, n, keys]

    return run


def _verify(pairs: DataFrame, texts: DataFrame, deltas: bool = False) -> DataFrame:
    """``pairs`` (a, b) with similarity ``j``, and with ``deltas`` also |A|, |B| and A's signed difference.

    Both texts reach one task through two joins; a text is never sent to a whole bucket.
    """
    t = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    u = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.select("a", "b").join(t, "a").join(u, "b")
    fields = [T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("j", T.DoubleType())]
    if deltas:
        fields += [T.StructField("na", T.LongType()), T.StructField("nb", T.LongType()),
                   T.StructField("delta", T.ArrayType(T.LongType(), False))]
    kinds = [pa.binary(), pa.binary(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}

        def of(i: bytes, text: str) -> tuple:
            if i not in known:
                if len(known) > 64:
                    known.clear()
                known[i] = multiset(text)
            return known[i]

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                out: list[list] = [[] for _ in fields]
                for a, b, ta, tb in zip(part["a"], part["b"], part["ta"], part["tb"], strict=True):
                    x, y = of(a, ta), of(b, tb)
                    low, high = overlap(x, y)
                    row = [a, b, low / high]
                    if deltas:
                        row += [int(x[1].sum()), int(y[1].sum()), difference(x, y)]
                    for o, v in zip(out, row, strict=True):
                        o.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=[f.name for f in fields])

    return both.mapInArrow(run, T.StructType(fields))


def difference(x: tuple, y: tuple) -> list[int]:
    """Signed difference of two multisets as element hashes: what x adds first, then what it lacks.

    The i-th extra or lacking copy of a shingle is an element of its own, counted from the
    smaller multiplicity towards y's, so that equal changes give equal elements.
    """
    out = []
    for s, (p, q) in ((1, (x, y)), (2, (y, x))):
        pos = np.searchsorted(q[0], p[0])
        pos[pos == len(q[0])] = 0
        other = np.where(q[0][pos] == p[0], q[1][pos], 0)
        gain = p[1] - other
        up = gain > 0
        h, n, o = p[0][up], gain[up], (other if s == 1 else p[1] - 1)[up]
        idx = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        level = np.repeat(o, n) + (idx if s == 1 else -idx)
        e = mix64(np.repeat(h, n) + (level.astype(np.uint64) * np.uint64(2) + np.uint64(s)) * _G)
        out += np.sort(e).view(np.int64).tolist()
    return out


def size_class(n: int) -> int:
    """Class of a difference size: steps of a factor 1.5; an empty difference is class 0."""
    return 0 if n == 0 else 1 + int(math.log(n) / math.log(1.5) + 1e-9)


def class_range(k: int) -> tuple[int, int]:
    """Smallest and largest size of a class."""
    if k == 0:
        return 0, 0
    lo = max(1, math.floor(1.5 ** (k - 1)) - 1)
    while size_class(lo) < k:
        lo += 1
    hi = math.ceil(1.5 ** k) + 1
    while hi > lo and size_class(hi) > k:
        hi -= 1
    return lo, hi


def prefix_rows(d: int, n: int, n_leader: int, linked: bool) -> list[tuple[int, int, int]]:
    """(low class, high class, length of prefix) under which a member looks for partners.

    For a partner whose difference has a size of class k, at least [lo, hi], and |B| <= 1.25 |A|,
    |B| <= |leader| + hi: common elements needed >= (|dA| + lo - (|A| + |B|)/9) / 2, and at least
    one unless both members link to the leader. Members that need t of their d elements in common
    must share one of the first d - t + 1, in any fixed order.
    """
    own, out = size_class(d), []
    unlinked = math.floor((0.8 * n + n_leader) / 9 + 1e-9) + 1  # least difference of a partner that doesn't link
    for k in range(1, size_class(max(1, 3 * d + n_leader)) + 1):
        lo, hi = class_range(k)
        if lo > hi or linked and hi < unlinked:
            continue  # a linked member looks for members that don't link to the leader only
        lo = max(lo, unlinked) if linked else lo
        need = (d + lo - (n + min(math.floor(1.25 * n + 1e-9), n_leader + hi)) / 9) / 2
        need = max(1, math.ceil(need - 1e-9))
        if need <= min(d, hi):
            out.append((min(own, k), max(own, k), d - need + 1))
    return out


def _rarest_first(members: DataFrame) -> DataFrame:
    """``members`` with ``delta`` as (members, element), by the number of the leader's members that have the element.

    The order is the same for all members of a leader, ties by the element.
    """
    one = members.select("a", "leader", F.explode("delta").alias("e"))
    one = one.select("a", "leader", F.xxhash64("leader", "e").alias("element"))
    count = one.groupBy("leader", "element").agg(F.count(F.lit(1)).cast("int").alias("members"))
    order = (one.join(count, ["leader", "element"]).groupBy("a", "leader")
             .agg(F.array_sort(F.collect_list(F.struct("members", "element"))).alias("delta")))
    return members.drop("delta").join(order, ["a", "leader"])


def _prefixes(members: DataFrame) -> DataFrame:
    """One row per member, pair of classes and prefix element; the key joins leader, classes and element.

    Elements come rarest first. Those that no other member has fill the first positions of the
    prefix and give no row, as they can't be common to a pair.
    """
    kinds = {"key": pa.int64(), "a": pa.binary(), "comp": pa.int64(), "linked": pa.bool_(), "pos": pa.int32(), "d": pa.int32(),
             "n": pa.int32(), "leader": pa.int64(), "leaders": pa.list_(pa.int64())}
    schema = "key long, a binary, comp long, linked boolean, pos int, d int, n int, leader long, leaders array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out: list[tuple] = []
                p = batch.slice(at, 64).to_pydict()
                for a, comp, delta, n, nl, linked, *of in zip(
                        *(p[c] for c in ("a", "comp", "delta", "na", "nb", "linked", "leader", "leaders")), strict=True):
                    d = len(delta)
                    elements = np.array([e["element"] for e in delta], np.int64).view(np.uint64)
                    alone = sum(e["members"] == 1 for e in delta)
                    for lo, hi, length in prefix_rows(d, n, nl, linked):
                        keys = mix64(elements[alone:length] + _times(lo * 1000 + hi + 1)).view(np.int64)
                        out += [(k, a, comp, linked, i, d, n, *of) for i, k in enumerate(keys.tolist(), alone + 1)]
                cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    return members.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, copy_id, class_id, n_shingles) of each row.

    ``copy_id`` is the smallest id with the same words, ``class_id`` the smallest id of the
    connected component of links. Without words both are the row's own id.
    """
    if not math.isclose(threshold, THRESHOLD):
        raise ValueError("the difference bound is made for a similarity of 0.8")
    src = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    signed = cut(append_columns(src, "text", _sign, SIGNED, keep=["id"]))
    classes = (signed.where("node is not null").groupBy("node")
               .agg(F.min(F.struct("id", "keys")).alias("s"), F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("copies")))
    holders = classes.select("node", "copies", F.explode("s.keys").alias("key"))
    shared = holders.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("size")).where("n > 1")
    buckets = cut(holders.join(shared, "key").select("key", "node", "size"))
    fame = buckets.groupBy("node").agg(F.sum("size").alias("fame"))
    leaders = (buckets.join(fame, "node").groupBy("key").agg(F.max(F.struct("fame", "node")).alias("l"))
               .select("key", F.col("l.node").alias("leader")))
    stars = cut(buckets.join(leaders, "key").where("node <> leader")
                .select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct())
    texts = cut(_class_texts(src, classes.select("node", F.col("copy_id").alias("id")), buckets.select("node").distinct()))
    checked = cut(_verify(stars, texts))
    links = checked.where(F.col("j") >= threshold).select("a", "b")
    links = cut(links.unionByName(_links_beyond_leaders(checked, links, texts, threshold)))
    comp = components(links)

    named = classes.select("node", "copy_id", "copies").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classed = named.join(named.groupBy("comp").agg(F.min("copy_id").alias("class_id")), "comp").drop("comp")
    out = _with_class(signed.select("id", "n", "node"), cut(classed))
    return out.select(F.col("id").alias("doc_id"), F.coalesce("copy_id", "id").alias("copy_id"),
                      F.coalesce("class_id", "id").alias("class_id"), F.col("n").alias("n_shingles"))


def _with_class(rows: DataFrame, classed: DataFrame) -> DataFrame:
    """``rows`` with ``copy_id`` and ``class_id`` of their node, no node's rows in one task.

    Nodes with a ``1 / HOT_NODES`` share of all rows or more, at most ``HOT_NODES`` many, are sent to
    the rows; the others are joined by their node, the rows already served under a key of their own.
    """
    total = classed.agg(F.sum("copies")).scalar()
    hot = classed.where(F.col("copies") * HOT_NODES >= total)
    hot = hot.select("node", F.lit(True).alias("hot"), F.col("copy_id").alias("hot_copy"), F.col("class_id").alias("hot_class"))
    rows = rows.join(F.broadcast(hot), "node", "left")
    # the number of a row (of checkpointed rows: the same in every attempt); 8 bytes are no node
    own = F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    rows = rows.withColumn("at", F.when(F.col("hot") | F.col("node").isNull(), own).otherwise(F.col("node")))
    rest = classed.where(F.col("copies") * HOT_NODES < total).select(F.col("node").alias("at"), "copy_id", "class_id")
    return rows.join(rest, "at", "left").select("id", "n", F.coalesce("hot_copy", "copy_id").alias("copy_id"),
                                                F.coalesce("hot_class", "class_id").alias("class_id"))


def _class_texts(src: DataFrame, ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text): one text of each wanted copy class.

    Fetched by the id of one of the class' rows; where rows repeat an id with other words, the
    text whose words give the class' hash is the one.
    """
    ids = ids.join(nodes, "node", "left_semi")
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("text", T.StringType())])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yes = [xxhash.xxh3_128_digest(word_hashes(t).tobytes()) == x
                       for t, x in zip(texts, part.column(part.schema.get_field_index("node")).to_pylist(), strict=True)]
                yield part.select(["node", "text"]).filter(pa.array(yes, pa.bool_()))

    got = src.where("text is not null").join(ids, src["id"].eqNullSafe(ids["id"])).select("node", "text")
    return got.mapInArrow(own, schema).groupBy("node").agg(F.max("text").alias("text"))


def _links_beyond_leaders(checked: DataFrame, links: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members of a leader's buckets that lie in different components so far."""
    comp = components(links)
    member = (checked.join(comp.withColumnRenamed("node", "a"), "a", "left")
              .select("a", "b", (F.col("j") >= threshold).alias("linked"), F.coalesce("comp", "a").alias("comp")))
    spans = (member.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("n > 1 and lo <> hi").select("b"))
    rest = member.join(spans, "b").withColumn("leader", F.xxhash64("b"))
    # a member has at most one leader per band
    leaders = rest.groupBy("a").agg(F.array_sort(F.collect_set("leader")).alias("leaders"))
    rest = cut(rest.join(leaders, "a"))
    deltas = _verify(rest, texts, deltas=True).drop("j").join(rest, ["a", "b"])
    looked = _prefixes(cut(_rarest_first(cut(deltas.withColumn("comp", F.xxhash64("comp"))))))
    x, y = (looked.select("key", *(F.col(c).alias(f"{c}{i}") for c in looked.columns if c != "key")) for i in (1, 2))
    # the exact number of common elements a pair needs, and with it the exact prefixes
    need = F.expr("greatest(1, ceil((d1 + d2 - (n1 + n2) / 9) / 2 - 1e-9))")
    pairs = (x.join(y, "key").where("leader1 = leader2 and a1 < a2 and comp1 <> comp2 and not (linked1 and linked2)")
             .where((F.col("pos1") <= F.col("d1") - need + 1) & (F.col("pos2") <= F.col("d2") - need + 1))
             .where("least(n1, n2) * 5 >= greatest(n1, n2) * 4")
             .where("leader1 = array_intersect(leaders1, leaders2)[0]")
             .select(F.col("a1").alias("a"), F.col("a2").alias("b")).distinct())
    return _verify(pairs, texts).where(F.col("j") >= threshold).select("a", "b")
