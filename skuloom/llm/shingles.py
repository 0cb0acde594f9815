"""Sets of hashed word n-grams."""

from __future__ import annotations

import re

import numpy as np
import xxhash

NGRAM = 5
WORD = re.compile(r"[^\W_]+")
CACHE_WORDS = 100_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
MIX = np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hash of a word, kept for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str, hashes: WordHashes, n: int = NGRAM) -> np.ndarray:
    """The distinct hashes of the n-grams of words (runs of letters and digits, in lower case), sorted.

    A text of fewer words has one shingle of all of them, a text without words none.
    """
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    found = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        found ^= found >> np.uint64(29)
        found += h[i : i + len(found)] * ODD[i % len(ODD)]
        found *= MIX
    found ^= found >> np.uint64(31)
    return np.unique(found)
