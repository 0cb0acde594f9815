"""Minimal perfect hash functions of sets of 64-bit keys.

Level by level: every key left is hashed to a place of the level; a key that has its place for itself takes it, the others go
on to the next level. A key's number is the rank of its place among all taken ones, so n keys get the numbers 0 to n - 1.
A function is a few bits a key and tells nothing about other keys: `lookup` gives them any number or none, and the caller
compares the key stored under the number.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Places of a level per key that is left.
SPARE = 1.5


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers for every seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class PerfectHash(NamedTuple):
    """Places of each level, and one bit per place that says whether it is taken."""

    sizes: np.ndarray
    taken: np.ndarray

    def packed(self) -> bytes:
        return np.append(len(self.sizes), self.sizes).astype("<i8").tobytes() + np.packbits(self.taken).tobytes()

    @staticmethod
    def unpacked(data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8)
        return PerfectHash(sizes, np.unpackbits(np.frombuffer(data, np.uint8, offset=8 + 8 * n), count=int(sizes.sum())))

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of a key that is not in the set, any number or -1."""
        rank = np.cumsum(self.taken, dtype=np.int64) - self.taken
        found, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = base + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.taken[place] == 1
            found[left[hit]] = rank[place[hit]]
            left, base = left[~hit], base + size
        return found


def perfect_hash(keys: np.ndarray) -> PerfectHash:
    """The function of distinct keys."""
    sizes, taken = [], []
    while len(keys):
        size = int(len(keys) * SPARE) + 1
        place = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        uses = np.bincount(place, minlength=size)
        sizes.append(size)
        taken.append(uses == 1)
        keys = keys[uses[place] > 1]
    return PerfectHash(np.array(sizes, np.int64), np.concatenate([np.zeros(0, bool), *taken]).astype(np.uint8))
