"""Secret scan: fixed patterns, plus a randomness test battery with false-discovery control.

A candidate is a run of 16 or more characters of the usual text encodings, cut at ``=`` and at
base spans; where no one encoding holds it, its parts between ``/`` or ``+`` and those between
``-`` or ``_`` are candidates (random parts that overlap become one span). The encoding is
inferred from the characters. The battery (chi-squared test of the alphabet, runs test, serial
correlation) then answers two questions. Under uniform symbols of the encoding: does the run look
random (:func:`battery`)? Under the symbols of this corpus: can it be ordinary text
(:class:`TextModel`)? The second p-value is the one that is controlled: Benjamini-Hochberg runs in
each class of lengths over all candidates of the corpus, from exact counts per 1/16 of a natural
log unit (bounded by the largest log p, not by the rows).

A candidate needs a digit, as letters alone name no encoding, and 16 characters: definitions, not
tests. Of random keys the first loses 3.3 % at 20 symbols of base64 and 0.1 % at 40; the limit
``NOT_RANDOM`` loses 0.1 % of all.

Defined results: a null text counts as empty (no spans); repeated rows are scanned each; the
base spans never depend on other rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, col, cut, free_name, slices

# The three base patterns, in listed order, with their least lengths.
ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(HEX.replace("+", "{24,}"))  # a maximal run: the leftmost match of HEX
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_VALUE = re.compile(r"[^=]{16,}")
_PARTS = re.compile(r"[^/+]{16,}"), re.compile(r"[^-_]{16,}")  # base64url, base64

# Encodings from the narrowest alphabet to the widest (fixed values).
ENCODINGS = (
    ("decimal", "0123456789"), ("hex", "0123456789abcdef"), ("hex_upper", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36_upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_SETS = [(name, frozenset(a), {c: i for i, c in enumerate(a)}) for name, a in ENCODINGS]
_INDEX = {name: index for name, _, index in _SETS}
CELLS = 4  # parts of an alphabet, from its frequent to its rare symbols in the corpus
_CLASS = np.zeros(256, np.int8)  # kinds of characters of a run: lower, upper, digit, mark; 0 outside
for _kind, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_=-"), 1):
    _CLASS[[ord(_c) for _c in _chars]] = _kind
FDR = 0.001
NOT_RANDOM = 1e-3
BIN = 16  # bins of the log p-value per natural log unit


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three base kinds, leftmost and non-overlapping per kind."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    out.sort()
    return out


def infer_encoding(token: str) -> tuple[str, dict[str, int]] | None:
    """Narrowest encoding that holds all characters."""
    chars = set(token)
    if not chars & set("0123456789"):
        return None  # letters alone name no encoding: words, not keys
    for name, alphabet, index in _SETS:
        if chars <= alphabet:
            return name, index
    return None


def battery(token: str, index: dict[str, int]) -> float:
    """Fisher's joint p-value of the three tests, under uniform independent symbols."""
    x = np.array([index[c] for c in token], float)
    n, k = len(x), len(index)
    groups = min(k, max(2, n // 5))  # at least five expected in each cell
    cells = np.bincount((x * groups / k).astype(int), minlength=groups)
    share = np.bincount((np.arange(k) * groups / k).astype(int), minlength=groups) / k
    chi = float((((cells - n * share) ** 2) / (n * share)).sum())
    ps = [_chi2_tail(chi, groups - 1)]
    up = x >= k / 2
    a, b = int(up.sum()), int(n - up.sum())
    if a and b:
        runs = 1 + int((up[1:] != up[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        ps.append(math.erfc(abs(runs - mean) / math.sqrt(2 * var)))
    else:
        ps.append(2.0 ** (1 - n))
    z = x - (k - 1) / 2
    r = float((z[1:] * z[:-1]).sum()) / (((k * k - 1) / 12) * math.sqrt(n - 1))
    ps.append(math.erfc(abs(r) / math.sqrt(2)))
    stat = -2 * sum(math.log(max(p, 1e-300)) for p in ps)
    return _chi2_tail(stat, 6)


def _chi2_tail(x: float, df: int) -> float:
    """P(chi-squared with ``df`` degrees > x), by the Wilson-Hilferty normal approximation."""
    if df < 1 or x <= 0:
        return 1.0
    if df % 2 == 0 and df <= 40:  # exact
        term = total = 1.0
        for i in range(1, df // 2):
            term *= x / 2 / i
            total += term
        return min(1.0, math.exp(-x / 2) * total)
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _outside(s: int, e: int, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a run that lie outside the sorted base spans."""
    for a, _, b in taken:
        if s < b and a < e:
            if s < a:
                yield s, a
            s = b
    if s < e:
        yield s, e


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str]]:
    """Candidate (start, end, token, encoding) in text order that look random and touch no base span."""
    out = []
    for m in _CANDIDATE.finditer(text):
        for v in (v for s, e in _outside(*m.span(), taken) for v in _VALUE.finditer(text, s, e)):
            spans = {v.span()}
            if not (set("+/").isdisjoint(v.group()) or set("-_").isdisjoint(v.group())):
                spans = {p.span() for cuts in _PARTS for p in cuts.finditer(text, *v.span())}
            for s, e in sorted(spans):
                found = infer_encoding(text[s:e])
                if found and battery(text[s:e], found[1]) >= NOT_RANDOM:
                    out.append((s, e, text[s:e], found[0]))
    return out


def length_class(n: int) -> int:
    return n.bit_length()


def gather(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One pass over whole texts: counts of the corpus (cls -1) and random-looking candidates.

    Rows (cls, token, n): a partial sum per task of a code point, of the neighbours inside runs
    (``pairs``) and of those of two kinds (``changes``), or one candidate; reliable checkpoint, as
    the counts must be known before a candidate's p-value.
    """
    schema = T.StructType([T.StructField("cls", T.IntegerType()), T.StructField("token", T.StringType()),
                           T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = np.zeros(128, np.int64)
        pairs = changes = 0
        for batch in batches:
            for _, texts in slices(batch, text_col):
                found = []
                for t in texts:
                    raw = np.frombuffer(t.encode("utf-8", "replace"), np.uint8)
                    chars += np.bincount(raw, minlength=256)[:128]
                    kind = _CLASS[raw]
                    inside = (kind[1:] > 0) & (kind[:-1] > 0)
                    pairs += int(inside.sum())
                    changes += int((inside & (kind[1:] != kind[:-1])).sum())
                    found += [c[2] for c in candidates(t, base_spans(t))]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([length_class(len(t)) for t in found], pa.int32()), pa.array(found, pa.string()),
                         pa.array([1] * len(found), pa.int64())], names=["cls", "token", "n"])
        names, sums = [*map(chr, range(128)), "pairs", "changes"], [*chars.tolist(), pairs, changes]
        yield pa.RecordBatch.from_arrays([pa.array([-1] * 130, pa.int32()), pa.array(names, pa.string()), pa.array(sums, pa.int64())],
                                         names=["cls", "token", "n"])

    return cut(docs.select(col(text_col)).mapInArrow(run, schema))


def _binomial_tail(x: int, n: int, q: float) -> float:
    """Log of Chernoff's bound of P(Bin(n, q) >= x)."""
    if not n or x <= n * q:
        return 0.0
    share = x / n
    return -n * (share * math.log(share / q) + (0.0 if x == n else (1 - share) * math.log((1 - share) / (1 - q))))


class TextModel:
    """The battery under ordinary text: symbols of the corpus, and its rate of changes between kinds of characters."""

    def __init__(self, counts: dict[str, int], pairs: int, changes: int):
        self.change = (changes + 1) / (pairs + 2)
        self.cells: dict[str, tuple[dict[str, int], list[float], dict[str, bool], float]] = {}
        for name, alphabet in ENCODINGS:
            order = sorted(alphabet, key=lambda c: (-counts.get(c, 0), c))
            own = [counts.get(c, 0) + 1 for c in order]
            cell = {c: i * CELLS // len(order) for i, c in enumerate(order)}
            share = [sum(n for n, c in zip(own, order, strict=True) if cell[c] == i) / sum(own) for i in range(CELLS)]
            rare = {c: i >= len(order) // 2 for i, c in enumerate(order)}
            low = sum(n for n, c in zip(own, order, strict=True) if rare[c]) / sum(own)
            self.cells[name] = cell, share, rare, 2 * low * (1 - low)

    def tests(self, token: str, name: str) -> tuple[float, float, float]:
        """Log p-values of the three tests, each a bound that holds for any length."""
        cell, share, rare, unlike = self.cells[name]
        n = len(token)
        count = [0] * CELLS
        for c in token:
            count[cell[c]] += 1
        # chi-squared in its likelihood-ratio form; the number of possible counts bounds its tail (method of types)
        ratio = sum(x * math.log(x / (n * q)) for x, q in zip(count, share, strict=True) if x)
        chi = min(0.0, math.log(math.comb(n + CELLS - 1, CELLS - 1)) - ratio)
        kinds = _CLASS[np.frombuffer(token.encode("ascii"), np.uint8)]
        runs = _binomial_tail(int((kinds[1:] != kinds[:-1]).sum()), n - 1, self.change)
        marks = [rare[c] for c in token]  # serial: neighbours that are not both frequent or both rare, pairs apart
        serial = _binomial_tail(sum(x != y for x, y in zip(marks[::2], marks[1::2], strict=False)), n // 2, unlike)
        return chi, runs, serial

    def log_p(self, token: str, name: str) -> float:
        """Log p-value that the token is ordinary text: the least of the three times three, however they depend."""
        return min(0.0, math.log(3) + min(self.tests(token, name)))


def fit(docs: DataFrame, text_col: str = "text", fdr: float = FDR) -> tuple[TextModel, dict[int, int]]:
    """Model of the corpus' ordinary text, and per length class the highest bin of log p that passes.

    The driver gets 130 counts and one count per (length class, bin of log p).
    """
    seen = gather(docs, text_col)
    counts = {r.token: r.n for r in seen.where("cls = -1").groupBy("token").agg(F.sum("n").alias("n")).collect()}
    model = TextModel(counts, counts.pop("pairs", 0), counts.pop("changes", 0))

    @F.pandas_udf("int")
    def bins(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda t: math.ceil(BIN * model.log_p(t, infer_encoding(t)[0])))

    rows = seen.where("cls >= 0").select("cls", bins("token").alias("bin")).groupBy("cls", "bin").count().collect()
    limits: dict[int, int] = {}
    for c in {r["cls"] for r in rows}:
        own = sorted((r["bin"], r["count"]) for r in rows if r["cls"] == c)
        m, rank = sum(n for _, n in own), 0
        for b, n in own:  # Benjamini-Hochberg: the largest p within its share of the rate
            rank += n
            if math.exp(b / BIN) <= fdr * rank / m:
                limits[c] = b
    return model, limits


def scan(text: str, model: TextModel, limits: dict[int, int]) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end) of a text: base spans, and random ones within the rate."""
    base = base_spans(text)
    more: list[tuple[int, int, int]] = []
    for s, e, token, name in candidates(text, base):
        limit = limits.get(length_class(len(token)))
        if limit is not None and math.ceil(BIN * model.log_p(token, name)) <= limit:
            if more and s < more[-1][2]:  # the other cut of the same run
                s, e = more[-1][0], max(e, more.pop()[2])
            more.append((s, 3, e))
    return sorted(base + more) if more else base


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "spans", keep: list[str] | None = None,
                 fdr: float = FDR) -> DataFrame:
    """``docs`` with all spans of each whole text as an array of (kind, start, end)."""
    model, limits = fit(docs, text_col, fdr)

    def make():
        return lambda texts: [[[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t, model, limits)] for t in texts]]

    return append_columns(docs, text_col, make, [T.StructField(out, SPAN)], keep)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark`` (overlaps become one); null stays null."""
    model, limits = fit(docs, text_col, fdr)

    def clean(t: str) -> str:
        parts, at = [], 0
        for s, _, e in scan(t, model, limits):
            if s >= at:
                parts += [t[at:s], mark]
            at = max(at, e)
        return "".join(parts) + t[at:] if parts else t

    def make():
        return lambda texts: [[clean(t) for t in texts]]

    name = free_name(docs, "__clean")
    got = append_columns(docs, text_col, make, [T.StructField(name, T.StringType())])
    return got.withColumn(text_col, F.when(col(text_col).isNotNull(), F.col(name))).drop(name)
