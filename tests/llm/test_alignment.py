"""Cross-tokenizer alignment against a plain version, and the perfect hash."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from .conftest import SCHEMA, odd_documents, prose
from skuloom.llm import alignment as AL
from skuloom.llm.perfect_hash import PerfectHash, perfect_hash

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text):
    """Whole text through both libraries: (ids, byte ranges) of each, None where the bytes differ."""
    if not text:
        return None
    whole = (" " + text).encode()
    a = AL.byte_level(BYTES).encode(" " + text, add_special_tokens=False).ids
    b = AL.encoder(PIECES).encode(text)
    found = []
    for ids, table in ((a, AL.bytes_a(BYTES)), (b, AL.bytes_b(PIECES))):
        parts = [table[i] for i in ids]
        if b"".join(parts) != whole:
            return None
        ends = np.cumsum([len(p) for p in parts])
        found.append((ids, [(int(e) - len(p), int(e)) for e, p in zip(ends, parts, strict=True)]))
    return found


def plain_links(text):
    tokens = plain_tokens(text)
    if tokens is None:
        return None
    (a, spans_a), (b, spans_b) = tokens
    links = [(x, y) for x, (lo, hi) in zip(a, spans_a, strict=True) for y, (lo2, hi2) in zip(b, spans_b, strict=True) if max(lo, lo2) < min(hi, hi2)]
    cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
    groups, start = [], 0
    for cut in cuts:
        sides = (",".join(str(i) for i, (lo, hi) in zip(ids, spans, strict=True) if start <= lo and hi <= cut) for ids, spans in tokens)
        groups.append("|".join(sides))
        start = cut
    return len(a), len(b), groups, links


def plain(rows):
    every = [plain_links(t) for _, t, *_ in rows]
    counts = Counter(p for e in every if e for p in e[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    found = []
    for (i, *_), e in zip(rows, every, strict=True):
        if e is None:
            found.append((i, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        n_a, n_b, groups, links = e
        told = ";".join(groups)
        best, total = sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links)
        found.append((i, n_a, n_b, len(groups), len(links), best, total, hashlib.sha256(told.encode()).hexdigest(), told))
    return sorted(found, key=repr), counts


def documents():
    rows = [r for r in odd_documents() if r[0] not in (8, 9, 14)]
    rows += [(20, "<|endoftext|> <s> </s> <0x41> <unk>", "en", "s", 1), (21, "a ▁b", "en", "s", 1), (22, "日本語 と 中文 한국어 ​ é", "en", "s", 1)]
    rows += [(23, "x" * 900 + " " + "y1" * 300, "en", "s", 1), (24, "it's  2024-01-02\n\n  don't\t\ttabs   ", "en", "s", 1)]
    return rows + [(100 + i, prose(i, 60, 40) + " Überstraße, naïve.", "en", "s", 1) for i in range(30)]


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 700, "block_bytes": 3000, "fan": 3}, {"chunk_bytes": 300, "block_bytes": 10**6, "fan": 2}])
def test_documents_and_pairs(spark, sizes):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("chunk", "ids", "texts", "block", "grp", "pairs", "counts", "hash", "n_a", "groups", "best"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    found, table = AL.align(df, BYTES, PIECES, with_groups=True, **sizes)
    want, counts = plain(rows)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == want
    assert {(r["a"], r["b"]): r["n"] for r in AL.pairs_of(table).collect()} == dict(counts)


def test_nothing(nothing):
    found, table = AL.align(nothing, BYTES, PIECES)
    assert found.count() == 0 and AL.pairs_of(table).count() == 0
    assert found.columns == ["doc_id", *AL.COUNTS, "groups_sha256"]


def test_only_texts_without_tokens(spark):
    df = spark.createDataFrame([(1, None), (None, ""), (2, "▁")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in AL.align(df, BYTES, PIECES)[0].collect()} == {(0, 0, 0, 0, 0, 0, "")}


def in_units(texts):
    parts = AL.split([t.encode() for t in texts])
    units = AL.distinct_units(parts)
    tokens = AL.Tokens.unpacked(AL.tokens_of(units, BYTES, PIECES).packed())
    return AL.placed(parts, units, tokens, BYTES, PIECES)


def whole(text):
    """Groups and links of one text by way of its units, None without tokens."""
    (part,), found = in_units([text])
    if part is None:
        return None
    flat, sizes = AL.group_texts(found)
    ends, links = np.cumsum(sizes), np.cumsum(found.n_links)
    groups = b"".join(flat[ends[u] - sizes[u] : ends[u]].tobytes() for u in part)[:-1].decode()
    pairs = [int(x) for u in part for x in found.pairs[links[u] - found.n_links[u] : links[u]]]
    return int(found.n_a[part].sum()), int(found.n_b[part].sum()), groups, [(x >> 32, x & 0xFFFFFFFF) for x in pairs]


@pytest.mark.parametrize("step", [7, 100_000])
def test_long_text(monkeypatch, step):
    monkeypatch.setattr(AL, "STEP", step)
    for text in (prose(3, 3000, 900), "x" * 5000, "1" * 700 + "." * 100, "\n".join(prose(i, 20) for i in range(50))):
        n_a, n_b, groups, links = plain_links(text)
        assert whole(text) == (n_a, n_b, ";".join(groups), links)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" ab▁\n\t.é<s>'01 　\x1c\x85日")), max_size=40))
def test_units_are_the_whole_text(text):
    want = plain_links(text)
    assert whole(text) == (want and (want[0], want[1], ";".join(want[2]), want[3]))


@pytest.mark.parametrize("joined", [1, 3])
def test_units_in_any_company(monkeypatch, joined):
    """Units are the same alone and beside others, odd ones among them."""
    monkeypatch.setattr(AL, "JOINED", joined)
    texts = [t for _, t, *_ in documents() if t]
    parts, found = in_units(texts)
    for text, part in zip(texts, parts, strict=True):
        want = plain_links(text)
        assert (part is None) == (want is None)
        if want:
            assert (found.n_a[part].sum(), found.n_groups[part].sum()) == (want[0], len(want[2]))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        AL.check(public_tokenizers.path("word_bpe_49k.json"), PIECES)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1), max_size=300))
def test_perfect_hash(keys):
    values = np.array(sorted(keys), np.uint64)
    function = PerfectHash.unpacked(perfect_hash(values).packed())
    assert sorted(function.lookup(values).tolist()) == list(range(len(values)))


def test_perfect_hash_of_many():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 200_000).astype(np.uint64))
    function = perfect_hash(values)
    assert (np.sort(function.lookup(values)) == np.arange(len(values))).all()
    assert 8 * len(function.packed()) < 5 * len(values)


def test_numbers_travel():
    values = np.array([0, 3, 5, 1 << 40, (1 << 64) - 1], np.uint64)
    assert (AL.ascended(AL.ascending(values)) == values).all() and (AL.numbers(AL.blob(values)) == values).all()
    assert len(AL.numbers(AL.blob(values[:0]))) == 0
