"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edits.

Texts and items are sequences of lower-cased words. A passage is a leak of an item of n words
if it differs from the item by at most ``floor(0.2 n)`` word edits (a similarity of 0.8 or more).

1. Of an item's distinct word pairs, a leak keeps all but 2k at least (k edits break two pairs
   each). Counting them in a sliding window drops nearly all of a clean text and loses no leak.
2. Each window left, as long as an item, is embedded by the CGK random walk: step j writes the
   current word and moves on if a random bit of (j, word) is set, so that edit distance becomes
   Hamming distance once the walks of item and window meet again. Walks run forwards from the
   window's start and backwards from its end in turn. Each walk samples pairs of positions for
   its hash tables, each within a prefix of the walk of random scale, since matches thin out with
   every edit: so a round's recall hangs neither on the length of the item nor on where its edits lie.
3. Only a stretch of windows that shares a table's key with the item is a candidate. Rounds are
   repeated for what has none yet, until the target recall is reached by the recall of one round
   (``ROUND_RECALL``, a measured lower bound for items that use up all their edits).
4. Each candidate is verified by exact edit distances (Myers' bit vectors over words) from all
   starts of its stretch; the best passage is named. A recall of 1 verifies every stretch instead.

An item of the benchmark costs a few hundred bytes on each executor. Items are sent in blocks
of ``ITEM_BLOCK`` rows, with one pass over the documents per block, so what is broadcast is
bounded. Texts are not shuffled, and no document meets another.

Defined results: null or wordless texts and items match nothing; an item of one word is no
passage and matches nothing; repeated rows and ids are matched each; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, col, free_name, mix64, received, send, slices
from medalloy.llm.shingles import WORD, word_hashes

ITEM_BLOCK = 20_000
EDITS = (1, 5)  # word edits per word of an item, as a fraction: similarity 0.8
TABLES, BITS = 16, 2  # tables per walk, sampled positions per table
RECALL = 0.9995
ROUND_RECALL = 0.9  # of a walk each way; measured 0.94 to 1.00 (README)
HELD = 1 << 22  # symbols of embedded windows held at once
_SEED = 0x5DEECE66D


def allowed(n: int) -> int:
    return n * EDITS[0] // EDITS[1]


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix64(words[:-1] * np.uint64(3) + mix64(words[1:])) if len(words) > 1 else words[:0]


def rounds(recall: float) -> int:
    """Rounds (a walk forwards and one backwards) until a leak is missed with a probability of at most ``1 - recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - ROUND_RECALL))


def embed(words: np.ndarray, start: np.ndarray, end: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """CGK walk of the windows ``words[start:end]``: the symbols of the first ``steps`` steps, 0 past the end."""
    out = np.zeros((steps, len(start)), np.uint64)
    at = start.copy()
    for j in range(steps):
        on = at < end
        if not on.any():
            break
        sym = np.where(on, words[np.where(on, at, 0)], 0)
        out[j] = sym
        bit = mix64(sym + np.uint64((_SEED + walk * 1_000_003 + j * 7_919) & 0xFFFFFFFFFFFF)) >> np.uint64(63)
        at = at + bit.astype(np.int64)
    return out


def positions(n: int, walk: int) -> np.ndarray:
    """Sampled positions (TABLES, BITS) for items of ``n`` words: most walks end by step 2n."""
    rng = np.random.default_rng([n, walk])
    span = np.maximum(BITS, 2 * n * 2.0 ** -rng.uniform(0, math.log2(n), TABLES))
    return (rng.random((TABLES, BITS)) * span[:, None]).astype(np.int64)


def table_keys(words: np.ndarray, start: np.ndarray, end: np.ndarray, n: int, walk: int) -> np.ndarray:
    """Keys of the windows ``words[start:end]`` in the tables of one walk: (len(start), TABLES); odd walks run backwards."""
    pick = positions(n, walk)
    if walk % 2:
        words, start, end = words[::-1], len(words) - end, len(words) - start
    e = embed(words, start, end, walk, int(pick.max()) + 1)
    keys = np.empty((len(start), TABLES), np.uint64)
    for t in range(TABLES):
        k = np.full(len(start), t + 1, np.uint64)
        for b in pick[t]:
            k = mix64(k + e[b])
        keys[:, t] = k
    return keys


def prefix_distances(item: list[int], text: list[int], anywhere: bool = False) -> list[int]:
    """Edit distance of ``item`` to each prefix of ``text`` (lengths 0..len): Myers' bit vectors.

    ``anywhere``: to the best suffix of each prefix, so a passage may start at any word.
    """
    first = 0 if anywhere else 1
    m = len(item)
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, out = full, 0, m, [m]
    for w in text:
        eq = where.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1 | first) & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        out.append(score)
    return out


def best_passage(item: list[int], text: list[int], starts: list[int], k: int) -> tuple[int, int, int] | None:
    """(distance, first word, end word) of the best passage at one of the sorted ``starts``, if within ``k`` edits."""
    reach, back, best, lo = len(item) + k, item[::-1], None, 0
    for hi in range(len(starts)):
        if hi + 1 < len(starts) and starts[hi + 1] - starts[hi] < reach:
            continue
        own, lo = starts[lo:hi + 1], hi + 1
        region = text[own[0]:own[-1] + reach]
        got = prefix_distances(back, region[::-1], anywhere=True)  # by the words from the start to the region's end
        best = min([(got[len(region) - s + own[0]], s) for s in own] + ([best] if best else []))
    if best is None or best[0] > k:
        return None
    got = prefix_distances(item, text[best[1]:best[1] + reach])
    return best[0], best[1], best[1] + got.index(best[0])


class Matcher:
    """Tables of a block of items; matches whole texts."""

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL):
        self.items = [(i, w) for i, t in items if len(w := word_hashes(t or "")) > 1]
        self.rounds = rounds(recall) if recall < 1 else None
        owned = [np.unique(_pairs(w)) for _, w in self.items]
        # distinct pairs that a leak keeps at least: an edit breaks two
        self.needs = np.array([max(1, len(x) - 2 * allowed(len(w))) for x, (_, w) in zip(owned, self.items, strict=True)])
        self.least = int(self.needs.min()) if owned else 0
        flat = np.concatenate(owned) if owned else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(owned)), [len(x) for x in owned])
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.pairs, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.pairs >> np.uint64(42)).astype(np.int64)] = True

    def windows(self, words: np.ndarray) -> dict[int, list[tuple[int, np.ndarray]]]:
        """By item length: items and the window starts that hold enough of an item's pairs; complete for leaks."""
        if not self.items or len(words) < 2:
            return {}
        p = _pairs(words)
        at = np.flatnonzero(self.bits[(p >> np.uint64(42)).astype(np.int64)])
        if len(at) < self.least:
            return {}
        i = np.searchsorted(self.pairs, p[at])
        i[i == len(self.pairs)] = 0
        true = self.pairs[i] == p[at]
        at, i = at[true], i[true]
        if len(at) < self.least:
            return {}
        times = self.first[i + 1] - self.first[i]
        pos = np.repeat(at, times)
        item = self.owner[np.repeat(self.first[i], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        pair = np.repeat(i, times)
        kinds = np.unique(item * len(self.pairs) + pair)  # distinct (item, pair) in the text
        many = np.flatnonzero(np.bincount(kinds // len(self.pairs), minlength=len(self.items)) >= self.needs)
        starts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for a in many:
            n, need = len(self.items[a][1]), self.needs[a]
            reach, own, kind = n + allowed(n) - 1, pos[item == a], pair[item == a]
            # every window start whose reach holds enough distinct pairs: from the need-th pair on
            good: list[np.ndarray] = []
            count: dict[int, int] = {}
            tail = 0
            for head in range(len(own)):
                count[kind[head]] = count.get(kind[head], 0) + 1
                while own[head] - own[tail] >= reach:
                    count[kind[tail]] -= 1
                    if not count[kind[tail]]:
                        del count[kind[tail]]
                    tail += 1
                if len(count) >= need:
                    lo, t, left = max(0, own[head] - reach + 1), tail, dict(count)
                    while len(left) >= need:  # the last start that still holds enough
                        left[kind[t]] -= 1
                        if not left[kind[t]]:
                            del left[kind[t]]
                        t += 1
                    good.append(np.arange(lo, own[t - 1] + 1))
            if good:
                starts.setdefault(n, []).append((int(a), np.unique(np.concatenate(good))))
        return starts

    def match(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Per text: (item id, distance, first word, end word) of the best window of each leaked item."""
        hashed = [word_hashes(t) for t in texts]
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        by_len: dict[int, list[tuple[int, int, int, int]]] = {}  # (text, item, first start, last start) of each stretch
        for d, w in enumerate(hashed):
            for n, own in self.windows(w).items():
                for a, starts in own:
                    breaks = np.flatnonzero(np.diff(starts) > 1)
                    first, last = np.append(0, breaks + 1), np.append(breaks, len(starts) - 1)
                    by_len.setdefault(n, []).extend((d, a, int(starts[i]), int(starts[j])) for i, j in zip(first, last, strict=True))
        for n, stretches in by_len.items():
            for d, a, lo, hi in self._candidates(hashed, stretches, n):
                best = best_passage(self.items[a][1].tolist(), hashed[d].tolist(), list(range(lo, hi + 1)), allowed(n))
                if best and (a not in found[d] or best < found[d][a]):
                    found[d][a] = best
        return [[(self.items[a][0], *v) for a, v in sorted(f.items())] for f in found]

    def _candidates(self, hashed: list[np.ndarray], stretches: list[tuple[int, int, int, int]], n: int) -> list[tuple[int, int, int, int]]:
        """The stretches with a window that shares a key with the item in some round; all of them at a recall of 1."""
        if self.rounds is None:
            return stretches
        docs, items = ({x: i for i, x in enumerate(sorted({s[c] for s in stretches}))} for c in (0, 1))
        words = np.concatenate([hashed[d] for d in docs])
        shift = np.cumsum([0] + [len(hashed[d]) for d in docs])
        doc = np.array([docs[s[0]] for s in stretches])
        item = np.array([items[s[1]] for s in stretches])
        lo, hi = (np.array([s[c] for s in stretches]) for c in (2, 3))
        own = np.concatenate([self.items[a][1] for a in items])
        own_start = np.arange(len(items)) * n
        hit = np.zeros(len(stretches), bool)
        for walk in range(2 * self.rounds):
            left = np.flatnonzero(~hit)
            if not len(left):
                break
            early = allowed(n) * (walk % 2)  # windows read backwards: every end of a passage that starts in the stretch
            size = (hi - lo + 1 + early)[left]
            which = np.repeat(left, size)
            at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + (lo - early)[which]
            base = shift[doc[which]]
            start, end = base + np.maximum(at, 0), np.minimum(base + at + n, shift[doc[which] + 1])
            known = table_keys(own, own_start, own_start + n, n, walk)
            step = max(1, HELD // (2 * n))
            for i in range(0, len(which), step):
                part = slice(i, i + step)
                same = (table_keys(words, start[part], np.maximum(end, start)[part], n, walk) == known[item[which[part]]]).any(axis=1)
                hit[which[part][same]] = True
        return [s for s, h in zip(stretches, hit.tolist(), strict=True) if h]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``ITEM_BLOCK`` rows, the only part of a benchmark held at once."""
    blocks = max(1, math.ceil(items.count() / ITEM_BLOCK))
    slot = F.pmod(F.xxhash64(col(id_col), col(text_col)), F.lit(blocks))
    for b in range(blocks):
        rows = items.where(slot == b).select(col(id_col).cast("long").alias("i"), col(text_col).alias("t")).collect()
        yield sorted(((r.i, r.t) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, edits, start, end): the best passage of each leaked item in each row.

    ``start`` and ``end`` are code points of the whole text, the end exclusive. ``recall`` is the target
    of the candidate search; 1 verifies all that the lossless pair filter leaves.
    """
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "item_id", "edits", "start", "end")])
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    out = None
    for items_of in item_blocks(items, item_id, item_text):
        sent = send(docs.sparkSession, items_of)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = received(sent, lambda own: Matcher(own, recall))
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    rows: list[tuple] = []
                    ids = part.column(0).to_pylist()
                    for i, t, hits in zip(ids, texts, matcher.match(texts), strict=True):
                        if hits:
                            at = [m.span() for m in WORD.finditer(t.lower())] if len(t.lower()) == len(t) else _spans(t)
                            rows += [(i, item, d, at[s][0], at[max(s, e - 1)][1]) for item, d, s, e in hits]
                    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=schema.names)

        got = src.mapInArrow(run, schema)
        out = got if out is None else out.unionByName(got)
    return out


def _spans(text: str) -> list[tuple[int, int]]:
    """Spans of the words of the lower-cased text in the text itself, where lower-casing adds characters."""
    back, low = [], []
    for i, c in enumerate(text):
        x = c.lower()
        low.append(x)
        back += [i] * len(x)
    back.append(len(text))
    return [(back[m.start()], back[m.end() - 1] + 1) for m in WORD.finditer("".join(low))]


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", recall: float = RECALL) -> DataFrame:
    """``docs`` without the rows whose text holds a passage of an item (``recall`` as in :func:`find_leaks`)."""
    flag = free_name(docs, "__leaks")
    for items_of in item_blocks(items, item_id, item_text):
        sent = send(docs.sparkSession, items_of)

        def make(sent=sent):
            matcher = received(sent, lambda own: Matcher(own, recall))
            return lambda texts: [[len(h) for h in matcher.match(texts)]]

        docs = append_columns(docs, text_col, make, [T.StructField(flag, T.IntegerType())]).where(F.col(flag) == 0).drop(flag)
    return docs
