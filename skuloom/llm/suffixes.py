"""Arrays for repeated strings: window keys, suffix arrays, common prefixes, merging. Plain numpy on one chunk or bucket.

A window is a string of `WINDOW` bytes, named by where it starts. Its key is the least hash of the grams of `GRAM` bytes
inside it, so that equal windows have equal keys wherever they stand, and neighbouring windows mostly share one.
"""

from __future__ import annotations

import numpy as np

WINDOW = 50
GRAM = 24
PAD = 64
TILE = 1 << 16

A, B, C, D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: From here on a number has 2, 3, ... 8 bytes.
BYTE_STEPS = np.array([1 << 8 * i for i in range(1, 8)], np.uint64)


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as a big-endian number, which orders as the bytes do; zeros follow."""
    padded = np.concatenate([data, np.zeros(PAD + 8, np.uint8)])
    found = np.empty(len(data) + PAD, np.uint64)
    for o in range(8):
        own = found[o::8]
        own[:] = np.frombuffer(padded, ">u8", len(own), o)
    return found


def keys(x: np.ndarray, n: int) -> np.ndarray:
    """Key of the window at each of the first n positions of `words`."""
    found = np.empty(n, np.uint64)
    reach = WINDOW - GRAM
    for at in range(0, n, TILE):
        m = min(TILE, n - at)
        w = x[at : at + m + reach + 16]
        k = len(w) - 16
        h = (w[:k] * A) ^ (w[8 : 8 + k] * B)
        h ^= h >> np.uint64(29)
        h += w[16 : 16 + k] * C
        h ^= h >> np.uint64(32)
        h *= D
        h ^= h >> np.uint64(31)
        # least of `reach` + 1 neighbours, by doubling
        span = 1
        while span * 2 <= reach + 1:
            h = np.minimum(h[:-span], h[span:])
            span *= 2
        rest = reach + 1 - span
        found[at : at + m] = np.minimum(h[: len(h) - rest], h[rest:])[:m] if rest else h[:m]
    return found


def runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


def classes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and for each value its place among them."""
    order = np.argsort(values)
    found = values[order]
    first = runs(found)
    place = np.empty(len(values), np.int64)
    place[order] = np.repeat(np.arange(len(first)), lengths(first, len(values)))
    return found[first], place


def sort_by_eight(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first eight bytes; rank: the first place of the position's group."""
    order = np.argsort(x)
    rank = np.empty(len(x), np.int64)
    starts = runs(x[order])
    rank[order] = np.repeat(starts, lengths(starts, len(x)))
    return order, rank


def refine(order: np.ndarray, rank: np.ndarray, shift: int) -> None:
    """A Larsson-Sadakane step: groups that are still together are sorted by the rank `shift` further on, in place."""
    n = len(order)
    in_order = rank[order]
    starts = runs(in_order)
    sizes = lengths(starts, n)
    open_groups = np.repeat(sizes > 1, sizes)
    places = np.flatnonzero(open_groups)
    if not len(places):
        return
    members = order[places]
    later = members + shift
    second = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
    key = in_order[places].astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)
    by = np.argsort(key)
    members, key = members[by], key[by]
    order[places] = members
    first = runs(key)
    rank[members] = np.repeat(places[first], lengths(first, len(members)))


def suffix_order(x: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The picked positions in the order of their windows.

    Ranks of 8, 16 and 32 bytes are refined one from the other; a window is then ordered by the ranks of its first and
    of its last 32 bytes.
    """
    order, rank = sort_by_eight(x)
    refine(order, rank, 8)
    refine(order, rank, 16)
    last = rank[np.minimum(picked + (WINDOW - 32), len(x) - 1)].astype(np.uint64)
    return picked[np.argsort(rank[picked].astype(np.uint64) << np.uint64(32) | last)]


def common_prefixes(x: np.ndarray, order: np.ndarray, lanes: int = 2048) -> np.ndarray:
    """Length, up to WINDOW, of the prefix that each position of `order` shares with the one before it.

    Kasai's walk in text order: a position's prefix is at most one shorter than that of the position before it. That holds
    where both neighbours of the former pair are in `order` too and the pair differed inside the window, beyond which
    the order says nothing; elsewhere the comparison starts anew. Blocks of the text are walked side by side, one lane
    each, and the bytes are compared eight at a time.
    """
    n = len(order)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    by_text = np.argsort(order)
    here = order[by_text]
    before = np.where(by_text > 0, order[np.maximum(by_text - 1, 0)], -1)
    picked = np.zeros(len(x) + 1, bool)
    picked[order] = True
    carries = np.zeros(n, bool)
    carries[1:] = (here[1:] == here[:-1] + 1) & (before[:-1] >= 0) & picked[before[:-1] + 1]
    prefix = np.zeros(n, np.int64)
    steps = -(-n // lanes)
    at = np.arange(0, n, steps)
    h = np.zeros(len(at), np.int64)
    for t in range(steps):
        i = at + t
        live = i < n
        i, lane = i[live], np.flatnonzero(live)
        known = np.where(carries[i] & (h[lane] < WINDOW), np.maximum(h[lane] - 1, 0), 0)
        todo = np.flatnonzero(before[i] >= 0)
        while len(todo):
            a, b = here[i[todo]] + known[todo], before[i[todo]] + known[todo]
            differ = x[a] ^ x[b]
            some = differ != 0
            # leading bytes that agree
            same = np.where(some, 7 - np.searchsorted(BYTE_STEPS, differ, side="right"), 8)
            known[todo] += same
            todo = todo[~some & (known[todo] < WINDOW)]
        h[lane] = known
        prefix[i] = known
    found[by_text] = prefix
    return np.minimum(found, WINDOW)
