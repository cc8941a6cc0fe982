"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a whole pre-token that is a
vocabulary entry. Tier two: any other pre-token is merged by a heap of adjacent pairs over
linked bytes, O(n log n) also for a pre-token of many thousand bytes.

Defined results: a null text counts as empty and gives an empty id list; every byte is a
vocabulary entry, so every text can be encoded and decodes to its own UTF-8 bytes; repeated
rows are encoded each; other columns of the input are kept. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medalloy.llm.common import append_columns, mix64, received, send

# Pre-tokens resolved before are kept up to this number per Python worker (memory bound only).
CACHE = 400_000
# Upper bound of a vocabulary that is sent to executors whole.
MAX_VOCAB_BYTES = 32 * 1024 * 1024
# In texts of these characters alone, Python's classes equal the Unicode ones of the pattern:
# Latin letters without the numbers of category No and without U+001C to U+001F.
_PLAIN_BREAK = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def load_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank from a file of base64 entries and ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    if sum(map(len, out)) > MAX_VOCAB_BYTES:
        raise ValueError("vocabulary too large to be sent to executors whole")
    return out


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tokens), np.uint64, len(tokens))


class PerfectHash:
    """Minimal perfect hash by displacement: bucket → displacement → one of n slots."""

    def __init__(self, tokens: list[bytes]):
        n = len(tokens)
        self.n, self.buckets = n, max(1, n // 4)
        h = _hashes(tokens)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot_id = np.full(n, -1, np.int64)
        sizes = np.diff(starts)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            members = order[starts[b]:starts[b + 1]]
            d = 1
            while True:  # 64 displacements at a time
                tries = np.arange(d, d + 64, dtype=np.uint64)
                slots = self._slots(h[members][None, :], tries[:, None])
                ok = (self.slot_id[slots] < 0).all(1)
                for k in np.flatnonzero(ok):
                    if len(set(slots[k].tolist())) == len(members):
                        self.shift[b] = d + int(k)
                        self.slot_id[slots[k]] = members
                        break
                else:
                    d += 64
                    continue
                break
        free = iter(np.flatnonzero(self.slot_id < 0).tolist())
        for b in np.flatnonzero(sizes == 1):  # a lone entry takes any free slot, named directly
            slot = next(free)
            self.shift[b] = -slot - 1
            self.slot_id[slot] = order[starts[b]]

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (mix64(h + d * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, tokens: list[bytes]) -> np.ndarray:
        """Candidate entry of each token; the caller compares the entry's bytes."""
        h = _hashes(tokens)
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -d - 1, self._slots(h, np.maximum(d, 0).astype(np.uint64)))
        return self.slot_id[slot]


class Codec:
    """Encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, vocab: list[bytes], pattern: str, whole: PerfectHash | None = None):
        self.vocab = vocab
        self.ranks = {t: i for i, t in enumerate(vocab)}
        self.size_bits = max(map(len, vocab), default=1).bit_length()
        self.whole = whole or PerfectHash(vocab)
        self.exact = regex.compile(pattern)
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
        self.plain = None if r"\p" in plain else re.compile(plain)
        self.cache: dict[str, tuple[int, ...]] = {}

    def split(self, text: str) -> list[str]:
        if self.plain is not None and not _PLAIN_BREAK.search(text):
            return self.plain.findall(text)
        return self.exact.findall(text)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece: repeatedly joins the adjacent pair of lowest rank, leftmost first.

        ``end`` and ``prev`` link the parts by their first byte; a heap entry is one integer:
        rank, first byte and size of a joined pair. A pair whose left part is gone (end 0), or
        one of whose parts has grown since, no longer spans that size and is passed over.
        """
        get, n, sb, pb = self.ranks.get, len(piece), self.size_bits, len(piece).bit_length()
        end, prev = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r << pb | i) << sb | 2 for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapify(heap)
        sizes, starts = (1 << sb) - 1, (1 << pb) - 1
        while heap:
            e = heappop(heap)
            i = (e >> sb) & starts
            j = end[i]
            if not j or j >= n:
                continue
            k = end[j]
            if k - i != e & sizes:
                continue
            end[i], end[j] = k, 0
            if k < n:
                prev[k], q = i, end[k]
                if (r := get(piece[i:q])) is not None:
                    heappush(heap, (r << pb | i) << sb | q - i)
            h = prev[i]
            if h >= 0 and (r := get(piece[h:k])) is not None:
                heappush(heap, (r << pb | h) << sb | k - h)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def resolve(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.cache]
        if not new:
            return
        raw = [t.encode("utf-8", "surrogatepass") for t in new]
        vocab, cache = self.vocab, self.cache
        for t, b, i in zip(new, raw, self.whole.lookup(raw).tolist(), strict=True):
            cache[t] = (i,) if vocab[i] == b else self.merge(b)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.cache) > CACHE:
            self.cache.clear()
        out = []
        for text in texts:
            tokens = self.split(text)
            self.resolve(set(tokens))
            ids: list[int] = []
            for part in map(self.cache.__getitem__, tokens):
                ids += part
            out.append(ids)
            if len(self.cache) > 2 * CACHE:
                self.cache.clear()
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


def encode_decode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                  ids_col: str = "ids", bytes_col: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the ids of every whole text and the bytes that those ids decode to.

    The vocabulary (bounded by ``MAX_VOCAB_BYTES``) and its perfect hash are built once on the driver and
    broadcast.
    """
    vocab = load_ranks(ranks_path)
    sent = send(spark, (vocab, pattern, PerfectHash(vocab)))

    def make():
        codec = received(sent, lambda tables: Codec(*tables))

        def run(texts: list[str]) -> list:
            ids = codec.encode(texts)
            return [ids, [codec.decode(x) for x in ids]]

        return run

    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)), T.StructField(bytes_col, T.BinaryType())]
    return append_columns(docs, text_col, make, fields, keep)
