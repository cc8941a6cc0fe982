"""Words and hashed word shingles of whole texts."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from medalloy.llm.common import mix64

WORD = re.compile(r"\w+")
SHINGLE = 5


class WordHash(dict):
    """64-bit hash by word; emptied when it has grown large (memory bound only)."""

    LIMIT = 300_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


WORD_HASH = WordHash()


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-cased words of a text, in order."""
    words = WORD.findall(text.lower())
    return np.fromiter(map(WORD_HASH.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one shingle; no word, none."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = mix64(out + words[i:n - size + 1 + i])
    return out


def multiset(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (rising) and their counts."""
    return np.unique(shingle_hashes(word_hashes(text)), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of least counts, sum of greatest counts) of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low, int(a[1].sum() + b[1].sum()) - low
