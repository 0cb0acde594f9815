"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from .conftest import SCHEMA, odd_documents, prose
from skuloom.llm import simhash_join as SJ
from skuloom.llm.components import components

M64 = (1 << 64) - 1


def plain_print(text, n=4):
    """The contract, word for word."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    """Index of the smallest member of each one's component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def flipped(x, bits):
    for b in bits:
        x ^= 1 << b
    return x


def clusters(seed, n=25):
    """Chains that drift, dense balls, stars, pairs just inside and just outside the distance."""
    r = random.Random(seed)
    found = [0, M64]
    for _ in range(n):
        x = r.getrandbits(64)
        found += [flipped(x, r.sample(range(64), r.choice((4, 5)))) for _ in range(4)] + [x]
        for _ in range(12):
            x = flipped(x, r.sample(range(64), r.choice((3, 4, 4, 5))))
            found.append(x)
    centre = r.getrandbits(64)
    found += [flipped(centre, r.sample(range(64), r.randrange(1, 5))) for _ in range(150)]
    return sorted(set(found))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB \n\té\x0b\x1c ", max_size=80))
def test_fingerprint(text):
    assert SJ.fingerprint(text.encode()) == plain_print(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = prose(5, 3000, 50)
    monkeypatch.setattr(SJ, "BLOCK", 100)
    assert SJ.fingerprint(text.encode()) == plain_print(text)


@pytest.mark.parametrize("ring", [(4, 16, 0), (4, 16, 1), (4, 16, 2), (3, 16, 1), (4, 8, 1), (4, 8, 2), (6, 16, 2), (1, 4, 0)])
def test_every_pair_meets_and_passes(ring):
    """Any differences of at most d bits agree on a pattern and stay within its chain's shares, and no more bits do."""
    distance, segments, left_out = ring
    listed, r = SJ.patterns(left_out, distance, segments), random.Random(1)
    sets = [r.sample(range(64), r.randrange(distance + 1)) for _ in range(1500)]
    sets += [[(s * 64 // segments + k) % 64 for k in range(distance)] for s in range(segments)]
    for bits in sets:
        x = flipped(0, bits)
        met = [s for s, mask in listed if not x & mask]
        told = SJ.near(np.full(len(met), x, np.uint64), np.array(met, np.int64), distance, segments)
        assert len(told)
    far = np.array([flipped(0, r.sample(range(64), distance + 1 + i % 3)) for i in range(600)], np.uint64)
    for start in range(segments):
        assert not len(SJ.near(far, np.full(len(far), start), distance, segments))


@pytest.mark.parametrize("search", [{"left_out": 0}, {"left_out": 1}, {"left_out": 1, "tile": 9, "part_rows": 400}, {"left_out": 2, "tile": 40}, {}])
def test_links_keep_what_is_connected(spark, search):
    prints = clusters(3)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long").repartition(3)
    got = dict(components(SJ.links(df, **search), written=True).collect())
    roots = plain_components(prints)
    want: dict[int, set] = {}
    for p, root in zip(signed, roots, strict=True):
        want.setdefault(root, set()).add(p)
    found: dict[int, set] = {}
    for node, root in got.items():
        found.setdefault(root, set()).add(node)
    assert sorted(map(sorted, found.values())) == sorted(sorted(c) for c in want.values() if len(c) > 1)


@pytest.mark.parametrize("small", [0, 3, 1000])
def test_small_and_large_buckets_alike(monkeypatch, small):
    import pyarrow as pa

    monkeypatch.setattr(SJ, "SMALL", small)
    prints = np.array(clusters(8, 6), np.uint64)
    n = len(prints)
    table = pa.table({"print": prints.view(np.int64), "bucket": [1] * n, "start": [0] * n, "a": [0] * n, "b": [0] * n})
    edges = SJ.compare(table)
    # in one bucket a pair passes if the chain from this start does; from any start it must not pass beyond the distance
    for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist(), strict=True):
        roots = plain_components([int(p) for p in prints])
        index = {int(p) if p < 1 << 63 else int(p) - (1 << 64): i for i, p in enumerate(prints)}
        assert roots[index[a]] == roots[index[b]]
    assert len(edges) == len(set(edges["a"].to_pylist()))


def documents():
    rows, r = odd_documents(), random.Random(4)
    rows += [(300 + i, prose(40, 200), "en", "s", 1) for i in range(20)]
    for k in range(6):
        words = prose(50 + k, 300).split()
        for i in range(12):
            words[r.randrange(len(words))] = f"new{i}"
            rows.append((400 + 20 * k + i, " ".join(words), "en", "s", 1))
    return rows


@pytest.mark.parametrize("search", [{}, {"left_out": 1, "tile": 8}])
def test_documents(spark, search):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("print", "component_id", "fingerprint", "least", "best", "root", "node", "none", "id", "bucket", "start"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    got = sorted((tuple(r) for r in SJ.near_duplicates(df, **search).collect()), key=repr)
    prints = [plain_print(r[1]) for r in rows]
    roots = plain_components(prints)
    least = {}
    for row, root in zip(rows, roots, strict=True):
        least[root] = min((i for i in (row[0], least.get(root)) if i is not None), default=None)
    want = [(row[0], f"{p:016x}", least[root]) for row, p, root in zip(rows, prints, roots, strict=True)]
    assert got == sorted(want, key=repr)
    assert len({root for root in roots}) < len(rows) - 60


def test_only_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), ((1 << 63) - 1, "other text of its own")], "doc_id long, text string")
    got = {tuple(r)[::2] for r in SJ.near_duplicates(df).collect()}
    assert got == {(None, None), ((1 << 63) - 1, (1 << 63) - 1)}


def test_nothing(nothing):
    assert SJ.near_duplicates(nothing).count() == 0
