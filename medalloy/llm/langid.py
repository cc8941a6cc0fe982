"""Language identification by cross-parsing entropy.

Per language, a suffix automaton holds labelled running text: lower-cased words of letters with
single blanks between them. A whole text is cross-parsed against each: from left to right it is
cut into the longest phrases that the language's text contains, across words. The language with
the fewest normalised phrases (phrases per letter) wins. A phrase costs the same in every
language, so that one with a short learnt text gains nothing by it.

Learnt from a bounded, documented sample of the labelled rows' text: pieces of ``PIECE`` characters
from anywhere in the rows, picked by a hash of text and position; about ``SAMPLE_PIECES`` a language, and
of these, in hash order, what fits into ``SAMPLE_CHARS`` characters (fewer, if all languages together
would hold over ``TOTAL_CHARS``). Equal pieces of a language count once. Each language keeps its own
text, however little another has.

Texts of a batch are parsed side by side, a character of each in every language at a time, by the automata as one
table of numbers (``SideBySide``). Few or long texts left over, and languages over ``TABLE_CELLS``, go on one by one.

Defined results: ``und`` with score 0 for a text that is null or has no letter, or if nothing
was learnt; ties go to the alphabetically first language; with one language its score is 1.
Rows are predicted each, whatever their id or repetition.
"""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, col, received, send

PIECE = 4_000
SAMPLE_PIECES = 400
SAMPLE_CHARS = 80_000
TOTAL_CHARS = 1_000_000
TABLE_CELLS = 32_000_000  # of 4 bytes, in a worker
LANES = 16  # fewer texts side by side are slower than one by one
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def running(text: str) -> tuple[str, int]:
    """The words of letters, lower case, each between single blanks; and the number of letters."""
    words = _OTHER.sub(" ", text.lower()).split()
    letters = "".join(words)
    if not letters.isalpha():  # number signs that are no digits
        words = "".join(c if c.isalpha() else " " for c in " ".join(words)).split()
        letters = "".join(words)
    return f" {' '.join(words)} ", len(letters)


class SuffixAutomaton:
    """All substrings of a text; ``phrases`` counts longest matches."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        for to in self.next:  # a state leads to states, without their numbers
            for c, q in to.items():
                to[c] = self.next[q]

    def phrases(self, s: str, state: int = 0) -> int:
        """Number of greedy longest matches; a character never seen is a phrase of its own. From another
        state than the root's, the phrase it stands in counts too."""
        n, root = 0, self.next[0]
        state = self.next[state]
        for c in s:
            to = state.get(c)
            if to is None:
                n += 1  # the phrase before c ends; at the root, c alone is one
                if state is root:
                    continue
                to = root.get(c)
                if to is None:
                    n += 1
                    to = root
            state = to
        return n + (state is not root)


class SideBySide:
    """Automata as one table: a row per state, a column per character that the automaton's text holds, the first
    for all others. A cell is twice the row's place to go to, plus 1 if a phrase starts with the character there."""

    def __init__(self, automata: list[SuffixAutomaton]):
        self.automata = automata
        symbols = [sorted(a.next[0]) for a in automata]
        self.width = [len(s) + 1 for s in symbols]
        cells = [len(a.next) * w for a, w in zip(automata, self.width)]
        self.base = np.cumsum([0, *cells])
        self.table = np.empty(self.base[-1], dtype=np.int32)
        union = sorted(set().union(*symbols))
        self.code = np.zeros(sys.maxunicode + 1, dtype=np.intp)
        self.code[[ord(c) for c in union]] = np.arange(1, len(union) + 1)
        self.column = np.zeros((len(automata), len(union) + 1), dtype=np.intp)
        self.kind = np.zeros(sys.maxunicode + 1, dtype=np.uint8)  # 1: letter, 2: other, 0: not asked yet
        for k, (a, held) in enumerate(zip(automata, symbols)):
            column = {c: i for i, c in enumerate(held, 1)}
            self.column[k, self.code[[ord(c) for c in held]]] = np.arange(1, len(held) + 1)
            number = {id(state): i for i, state in enumerate(a.next)}
            rows = self.table[self.base[k]:self.base[k + 1]].reshape(len(a.next), self.width[k])

            def places(states, at=int(self.base[k]), width=self.width[k], number=number) -> np.ndarray:
                return 2 * (at + width * np.fromiter((number[id(s)] for s in states), dtype=np.int64))

            rows[:] = places([a.next[0], *(a.next[0][c] for c in held)]) + 1
            others = a.next[1:]  # at the root every character starts a phrase
            at = np.repeat(np.arange(1, len(a.next)), np.fromiter(map(len, others), dtype=np.int64))
            to = np.fromiter((column[c] for state in others for c in state), dtype=np.int64)
            rows[at, to] = places(state for other in others for state in other.values())

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text's running text (automata x texts), and its letters, as :func:`running` has them."""
        low = [t.lower() for t in texts]
        points = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self.kind.take(points)
        if not kind.all():
            for c in np.unique(points[kind == 0]):
                self.kind[c] = 1 if chr(c).isalpha() else 2
            kind = self.kind.take(points)
        letter = kind == 1
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one blank behind each word
        first = np.cumsum([0, *(len(t) + 1 for t in low[:-1])])
        letters = np.add.reduceat(letter, first, dtype=np.int64)
        size = np.add.reduceat(keep, first, dtype=np.int64)
        points = np.where(letter, points, np.uint32(ord(" ")))[keep]
        codes = self.code.take(points)

        lanes = np.argsort(-size, kind="stable")
        length = size[lanes]
        at = (np.cumsum(size) - size)[lanes]
        blank = self.column[:, self.code[ord(" ")]]
        state = np.repeat((self.table[self.base[:-1] + blank] >> 1).astype(np.intp)[:, None], len(texts), axis=1)
        n = np.ones(state.shape, dtype=np.int64)  # the blank in front starts a phrase
        step, k = 0, len(texts)
        while True:
            while k and length[k - 1] <= step:
                k -= 1
            if k < LANES:
                break
            cell = self.column.take(codes.take(at[:k] + step), axis=1)
            cell += state[:, :k]
            to = self.table.take(cell)
            n[:, :k] += to & 1
            np.right_shift(to, 1, out=state[:, :k])
            step += 1
        for i in range(k):
            rest = points[at[i] + step:at[i] + length[i]].tobytes().decode("utf-32-le", "surrogatepass")
            for j, a in enumerate(self.automata):
                inside = int(state[j, i] - self.base[j]) // self.width[j]
                n[j, i] += a.phrases(rest, inside) - (inside != 0)
        out = np.empty_like(n)
        out[:, lanes] = n
        return out, letters


class Classifier:
    """One automaton per language."""

    def __init__(self, learnt: dict[str, str]):
        self.langs = sorted(learnt)
        self.automata = [SuffixAutomaton(learnt[lang]) for lang in self.langs]
        self.tabled, cells = [], 0
        for k, a in enumerate(self.automata):
            if cells + len(a.next) * (len(a.next[0]) + 1) <= TABLE_CELLS:
                cells += len(a.next) * (len(a.next[0]) + 1)
                self.tabled.append(k)
        self.side_by_side = None

    def predict_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What ``predict`` gives, for many texts."""
        if not self.langs or not texts:
            return np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
        if self.side_by_side is None:
            self.side_by_side = SideBySide([self.automata[k] for k in self.tabled])
        n = np.empty((len(self.langs), len(texts)), dtype=np.int64)
        n[self.tabled], letters = self.side_by_side.phrases(texts)
        others = [k for k in range(len(self.langs)) if k not in self.tabled]
        for i, t in enumerate(texts if others else []):
            words = running(t)[0]
            n[others, i] = [self.automata[k].phrases(words) for k in others]
        cost = n / np.maximum(letters, 1)
        lang = np.array(self.langs, dtype=object)[cost.argmin(axis=0)]
        if len(cost) == 1:
            score = np.ones(len(texts))
        else:
            low = np.partition(cost, 1, axis=0)
            score = 1 - low[0] / low[1]
        lang[letters == 0], score[letters == 0] = UNKNOWN, 0.0
        return lang, score

    def predict(self, text: str) -> tuple[str, float]:
        words, letters = running(text)
        if not letters or not self.langs:
            return UNKNOWN, 0.0
        cost = [a.phrases(words) / letters for a in self.automata]
        if len(cost) == 1:
            return self.langs[0], 1.0
        first, second = sorted(cost)[:2]
        return self.langs[cost.index(first)], 1 - first / second


def learn(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
          sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Running text per language, from a bounded sample of the rows that ``train`` allows.

    No text is dealt by language: pieces are picked in the scan, at a rate that the language's size
    gives, and the driver gets at most ``sample_chars`` characters a language.
    """
    rows = docs.where(train).select(col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text <> '' and lang is not null")
    pieces = F.ceil(F.length("text") / PIECE).cast("int")
    totals = rows.groupBy("lang").agg(F.sum(pieces).alias("n"))
    sizes = totals.agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("sizes")).scalar()
    rate = F.lit(1e6) * SAMPLE_PIECES / F.try_element_at(sizes, F.col("lang"))
    rows = rows.select("text", "lang", F.xxhash64("text").alias("h"), rate.alias("rate"), F.sequence(F.lit(0), pieces - 1).alias("at"))

    def key(p: Column) -> Column:
        return F.xxhash64("h", p)

    picked = F.filter("at", lambda p: F.pmod(key(p), F.lit(1_000_000)) < F.col("rate"))
    found = F.transform(picked, lambda p: F.struct(key(p).alias("key"), F.substring("text", p * PIECE + 1, F.lit(PIECE)).alias("piece")))
    one = rows.select("lang", F.explode(found).alias("x")).groupBy("lang", "x.key").agg(F.min("x.piece").alias("piece"))
    upto = F.sum(F.length("piece")).over(Window.partitionBy("lang").orderBy("key"))
    bound = F.least(F.lit(sample_chars), F.floor(F.lit(TOTAL_CHARS) / F.size(sizes)))
    got = one.withColumn("upto", upto).where((F.col("upto") <= bound) | (F.col("upto") == F.length("piece")))
    out: dict[str, list[str]] = {}
    for r in got.select("lang", "key", "piece").collect():
        out.setdefault(r.lang, []).append((r.key, running(r.piece)[0]))
    return {lang: "\n".join(t for _, t in sorted(p)) for lang, p in sorted(out.items())}


def predict(docs: DataFrame, learnt: dict[str, str], text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the predicted language and a score: 1 - phrases of the winner / phrases of the next."""
    sent = send(docs.sparkSession, learnt)

    def make():
        model = received(sent, Classifier)

        def run(texts: list[str]) -> list:
            return list(model.predict_all(texts))

        return run

    return append_columns(docs, text_col, make, [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())], keep)
