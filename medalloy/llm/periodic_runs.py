"""Periodic runs of words: Lyndon arrays by Baier's grouping, Lyndon roots extended to runs.

The first phase of Baier's suffix sorter groups the suffixes of a sequence by their longest
Lyndon prefix: groups are taken from the highest to the lowest, and each suffix of a group
appends the group's prefix to the nearest suffix on its left that stands in a lower group. What
is left are the longest Lyndon words of all positions. By the runs theorem every run holds, in
the given or the reversed order of the words, a position whose longest Lyndon word is the run's
root; so each of these words is extended to both sides by longest common extensions (ranks of
all stretches of 2**k words) and is a run if it covers two periods.

Stretches in which no sequence of half the least length comes twice in its text hold no run of
that length and are left out before (lossless, see :func:`repeated_stretches`). Documents are
worked through in parallel, without a shuffle; the ranks take about 4 log2(n) bytes a word of a
text's repeated stretches.

Defined results: words are what white space (blank, tab, line feed, vertical tab, form feed,
carriage return) leaves; a null or empty text has no words, no runs and an empty collapsed text;
a run is told by its smallest period, runs come by start, then period; words are compared byte by
byte; repeated rows, null ids and further columns stay as they are; no rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, mix64

MIN_LENGTH = 12
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def lyndon_lengths(ranks: list[int], n_ranks: int) -> list[int]:
    """Length of the longest Lyndon word at each position, by Baier's grouping.

    ``ranks`` holds numbers from 0 to ``n_ranks`` - 1; rank 0 ends a sequence, so that several
    sequences are worked through at once, and has length 1.
    """
    n = len(ranks)
    group = list(ranks)
    members: list[list[int]] = [[] for _ in range(n_ranks)]
    for i, g in enumerate(ranks):
        members[g].append(i)
    width = [1] * n_ranks  # length of a group's Lyndon prefix
    below, above = list(range(-1, n_ranks - 1)), list(range(1, n_ranks + 1))  # the groups' order
    left, done = list(range(-1, n - 1)), bytearray(n)
    g = n_ranks - 1
    while g > 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in own:
            done[i] = 1
        hits: dict[int, int] = {}
        for i in own:
            p = left[i]
            if p >= 0 and done[p]:
                while p >= 0 and done[p]:
                    p = left[p]
                at = i
                while left[at] != p:  # shorten the way for later walks
                    left[at], at = p, left[at]
            if p >= 0 and group[p]:
                hits[p] = hits.get(p, 0) + 1
        grown: dict[tuple[int, int], int] = {}
        for p, times in sorted(hits.items(), key=lambda h: -h[1]) if len(hits) < len(own) else hits.items():
            old = group[p]
            new = grown.get((times, old))
            if new is None:  # directly above the old group, so below those with more copies
                new = grown[times, old] = len(width)
                width.append(width[old] + times * width[g])
                members.append([])
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = below[up] = new
            group[p] = new
            members[new].append(p)
        g = below[g]
    return [width[x] for x in group]


def repeated_stretches(ids: np.ndarray, starts: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches covered by sequences of ``min_length // 2`` words that occur twice in their text.

    ``starts`` are the first words of the texts. A run of ``m`` words and period ``q`` with
    ``m >= max(min_length, 2 * q)`` matches itself ``q`` words on over ``m - q`` words, at least
    half the least length, so that such sequences cover both its first and its last ``m - q``
    words: together the whole run. Hashes only select; equal sequences never differ in them.
    """
    n, size = len(ids), max(1, min_length // 2)
    text = np.zeros(n, np.int64)
    np.add.at(text, starts[(starts > 0) & (starts < n)], 1)
    text = np.cumsum(text)
    if n < 2 * size:
        return []
    with np.errstate(over="ignore"):
        h = mix64(text[:n - size + 1].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for k in range(size):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + ids[k:n - size + 1 + k].astype(np.uint64) + np.uint64(1))
    whole = text[:n - size + 1] == text[size - 1:]  # within one text
    at = np.flatnonzero(whole)
    order = np.sort(h[at])
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return []
    at = at[np.isin(h[at], twice)]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    covered = np.cumsum(cover[:n]) > 0
    edge = np.flatnonzero(covered[1:] != covered[:-1]) + 1
    cuts = np.unique(np.concatenate([[0], edge, starts[starts < n], [n]]))
    return [(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if covered[a] and b - a >= min_length]


class Extensions:
    """Longest common extensions by ranks of all stretches of 2**k items (exact)."""

    def __init__(self, items: np.ndarray, longest: int):
        self.levels = [np.unique(items, return_inverse=True)[1].astype(np.int32)]
        while (step := 1 << len(self.levels)) <= longest and step <= len(items):
            r = self.levels[-1].astype(np.int64)
            half = step >> 1
            kinds, r = np.unique(r[:len(r) - half] * (int(r.max()) + 1) + r[half:], return_inverse=True)
            if len(kinds) == len(r):
                break
            self.levels.append(r.astype(np.int32))

    def _walk(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        got = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            r, step = self.levels[k], 1 << k
            i, j = (a - got - step + 1, b - got - step + 1) if back else (a + got, b + got)
            fits = (i >= 0) & (j >= 0) & (i < len(r)) & (j < len(r))
            got += step * (fits & (r[np.where(fits, i, 0)] == r[np.where(fits, j, 0)]))
        return got

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Items that agree from positions ``a`` and ``b`` on."""
        return self._walk(a, b, False)

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Items that agree up to positions ``a`` and ``b``."""
        return self._walk(a, b, True)


def runs_of(ids: np.ndarray, starts: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (first word, length, period) of all runs, by first word and period; runs stay within a text."""
    parts = repeated_stretches(ids, starts, min_length)
    if not parts:
        return np.empty((0, 3), np.int64)
    place = np.concatenate([np.concatenate([[-1], np.arange(a, b)]) for a, b in parts] + [[-1]])
    word = place >= 0
    kinds, inverse = np.unique(ids[place[word]], return_inverse=True)
    ranks = np.zeros(len(place), np.int64)
    ranks[word] = inverse + 1
    items = ranks + len(parts) + 1
    items[~word] = np.arange((~word).sum())  # every end differs from every other
    lce = Extensions(items, max(b - a for a, b in parts))
    found = []
    for order in (ranks, np.where(word, len(kinds) + 1 - ranks, 0)):
        q = np.array(lyndon_lengths(order.tolist(), len(kinds) + 1), np.int64)
        i = np.flatnonzero(word & (np.arange(len(q)) + q < len(q)))
        q = q[i]
        back, on = lce.left(i - 1, i + q - 1), lce.right(i, i + q)
        length = back + q + on
        ok = length >= np.maximum(min_length, 2 * q)
        found.append(np.stack([place[(i - back)[ok]], length[ok], q[ok]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _finder(min_length: int) -> Callable[[list[str]], list]:
    def find(texts: list[str]) -> list:
        words = [t.encode().split() for t in texts]  # bytes.split() parts at exactly these six characters
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        flat = [w for own in words for w in own]
        code = {w: i for i, w in enumerate(set(flat))}
        ids = np.fromiter(map(code.__getitem__, flat), np.int64, len(flat))
        runs = runs_of(ids, starts[sizes > 0], min_length)
        drop = np.zeros(len(flat) + 1, np.int64)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
        keep = np.cumsum(drop[:-1]) == 0
        first, last = np.searchsorted(runs[:, 0], starts), np.searchsorted(runs[:, 0], ends)
        listed, collapsed = [], []
        for k, own in enumerate(words):
            a = int(starts[k])
            mine = runs[first[k]:last[k]]
            listed.append([{"start": s - a, "length": m, "period": q} for s, m, q in mine.tolist()])
            if len(mine):
                own = [own[x] for x in np.flatnonzero(keep[a:int(ends[k])]).tolist()]
            collapsed.append(b" ".join(own).decode())
        return [sizes, listed, collapsed]

    return find


def detect(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists (start, length, period) in words, from 0, of every run of ``min_length`` words
    and two periods or more. ``collapsed`` is the text without each run's words after its first
    period, joined by one blank.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    return append_columns(docs, text_col, lambda: _finder(min_length), fields, keep)
