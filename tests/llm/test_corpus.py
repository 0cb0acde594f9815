"""Operators that compare documents, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import by_row, odd_documents, prose
from skuloom.llm import components, decontaminate, ngram_join, suffix_dedup, suffixes, warc
from skuloom.llm.common import LAST
from skuloom.llm.shingles import WordHashes, shingle_set

DOCS = "doc_id long, text string"


def edited(text, every, seed):
    r = random.Random(seed)
    words = text.split()
    for i in range(r.randrange(every), len(words), every):
        words[i] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def corpus():
    """Copies, near copies, shared passages, and the odd documents."""
    base = [prose(100 + i, 150) for i in range(6)]
    passage = prose(7, 70)
    rows = [(1000 + i, t) for i, t in enumerate(base)]
    rows += [(1100 + i, base[0]) for i in range(30)]
    rows += [(1200 + i, edited(base[1], 90, i)) for i in range(40)]
    rows += [(1300 + i, edited(base[2], 25, i)) for i in range(10)]
    rows += [(1400 + i, f"{prose(900 + i, 60)} {passage} {prose(950 + i, 20 + i)}") for i in range(12)]
    return rows + [(i, t) for i, t, *_ in odd_documents()]


# --- suffix arrays


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"ab", b"x" * 30, b"repeat me " * 6, b"\x00\xff", b"z"]), min_size=1, max_size=30).map(b"".join), st.integers(1, 7))
def test_suffix_order_and_prefixes(data, lanes):
    n = len(data) - suffixes.WINDOW + 1
    if n < 1:
        return
    x = suffixes.words(np.frombuffer(data, np.uint8))
    picked = np.arange(n) if n % 2 else np.arange(0, n, 2)
    order = suffixes.suffix_order(x, picked)
    strings = [data[i : i + suffixes.WINDOW] for i in order]
    assert strings == sorted(strings) and sorted(order) == sorted(picked)
    want = [0] + [next((k for k, (p, q) in enumerate(zip(a, b)) if p != q), suffixes.WINDOW) for a, b in zip(strings, strings[1:])]
    assert suffixes.common_prefixes(x, order, lanes).tolist() == want


def test_equal_windows_have_equal_keys():
    r = np.random.default_rng(0)
    window = r.integers(0, 256, 50, np.uint8)
    data = [np.concatenate([r.integers(0, 256, n, np.uint8), window, r.integers(0, 256, 90, np.uint8)]) for n in (3, 40, 77)]
    found = {int(suffixes.keys(suffixes.words(d), len(d))[n]) for d, n in zip(data, (3, 40, 77))}
    assert len(found) == 1


def plain_dedup(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], LAST if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (LAST if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(4_000_000, 16_000_000, 4_000_000), (9_000, 20_000, 7_000)])
def test_suffix_dedup(spark, sizes):
    rows = corpus()
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(4), *sizes))
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain_dedup(rows)


def test_merge_of_many_shards_is_one_pass(monkeypatch):
    common = bytes(np.random.default_rng(3).integers(97, 123, 75, np.uint8))
    blobs, want, passes = [], {}, []
    shards = range(300)
    for k in shards:
        # three documents: one with a part of the common string, one with all of it twice, one of its own
        own = bytes(np.random.default_rng(1000 + k).integers(65, 91, 60, np.uint8))
        parts = [(0, 10, 10_000 - k, common[5:70]), (2, 4, 500 - k, common), (2, 30, 500 - k, common), (5, 0, k, own)]
        place, start, doc, body = zip(*parts, strict=True)
        count = [len(b) - suffixes.WINDOW + 1 for b in body]
        head = np.concatenate([[len(parts)], place, start, count, doc]).astype("<i8")
        blobs.append(zstandard.ZstdCompressor().compress(head.tobytes() + b"".join(body)))
        # the second document of the last shard is the first that has the common string
        want[1000 + k] = [(0, 10, 75)] + [(2, 4, 105)] * (k != shards[-1])
    ranges_of = suffix_dedup.ranges_of
    monkeypatch.setattr(suffix_dedup, "ranges_of", lambda *a: passes.append(1) or ranges_of(*a))
    found = suffix_dedup.merge([1000 + k for k in shards], blobs)
    assert {c: list(zip(*(x.tolist() for x in r), strict=True)) for c, r in found.items()} == want
    # not one over all windows for each shard
    assert len(passes) == 1


def test_suffix_dedup_of_odd_and_nothing(odd, nothing):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(odd, 5_000, 5_000, 5_000))
    want = plain_dedup([(i, t) for i, t, *_ in odd_documents()])
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.remove_repeats(nothing).count() == 0


# --- similarity join


def plain_links(rows, threshold=0.8):
    """Links and smallest id of each group, by comparing all pairs that share a shingle."""
    hashes = WordHashes()
    sets = [set(shingle_set(t or "", hashes).tolist()) for _, t in rows]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for v in s:
            holders[v].append(k)
    common = Counter()
    for own in holders.values():
        common.update((a, b) for n, a in enumerate(own) for b in own[n + 1 :])
    links, parent = Counter(), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), LAST), LAST if i is None else i)
    return sorted(((i, None if (c := least[root(k)]) == LAST else c, links[k]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("tile", [512, 7])
def test_ngram_join(spark, tile):
    rows = corpus()
    found = ngram_join.similarity_join(spark.createDataFrame(rows, DOCS).repartition(4), tile=tile, part_bytes=20_000)
    assert by_row(found, "doc_id", "class_id", "n_links") == plain_links(rows)


def drifting():
    """Chains of versions that are like their neighbours only, and pairs of close groups joined by one text between them."""
    texts = []
    for g in range(30):
        words = prose(700 + g, 64).split()
        for v in range(10):
            texts.append(" ".join(words))
            words[3 + 6 * v] = f"next{g}x{v}"
    for g in range(30):
        words = prose(800 + g, 100).split()
        # one word replaced in the text between; three differ across the groups, one inside a group
        between = [*words[:50], f"side{g}", *words[51:]]
        texts.append(" ".join(between))
        for v in range(4):
            texts.append(" ".join([*words[:10], f"own{g}x{v}", *words[11:]]))
            texts.append(" ".join([*between[:80], f"own{g}x{v}", *between[81:]]))
    rows = list(enumerate(texts))
    random.Random(9).shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [512, 3])
def test_ngram_join_keeps_what_links_connect(spark, tile):
    rows = drifting()
    found = ngram_join.similarity_join(spark.createDataFrame(rows, DOCS).repartition(4), tile=tile, part_bytes=20_000)
    assert by_row(found, "doc_id", "class_id") == sorted(((i, c) for i, c, _ in plain_links(rows)), key=repr)


def test_connected_of_random_links():
    r = np.random.default_rng(4)
    for n in range(1, 60):
        links = r.random((n, n)) < 1.2 / n
        links |= links.T
        np.fill_diagonal(links, False)
        want = np.arange(n)
        for _ in range(n):
            want = np.minimum(want, np.where(links, want, n).min(1))
        assert ngram_join.connected(links).tolist() == want.tolist()


def test_compare_connects_a_path_of_four():
    # b - d - a - c in keys, where each of d and a has a smaller neighbour than the other
    words = prose(900, 64).split()
    hashes, rows = WordHashes(), []
    for v, key in enumerate((b"b", b"c", b"d", b"a")):
        rows.append((1, 0, 0, key, 1, 0, [1], shingle_set(" ".join(words), hashes).tobytes()))
        words[3 + 6 * v] = f"next{v}"
    names = ("bucket", "a", "b", "key", "n", "tile", "buckets", "shingles")
    got = ngram_join.compare(pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))), 0.8).to_pylist()
    assert sorted((r["key"], r["links"], r["least"]) for r in got) == [
        (b"a", 1, b"a"), (b"b", 1, b"a"), (b"c", 2, b"a"), (b"d", 2, b"a"),
    ]


def test_ngram_join_of_odd_and_nothing(odd, nothing):
    want = plain_links([(i, t) for i, t, *_ in odd_documents()])
    assert by_row(ngram_join.similarity_join(odd), "doc_id", "class_id", "n_links") == want
    assert ngram_join.similarity_join(nothing).count() == 0


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.7, 0.8, 0.9):
        bands, rows = ngram_join.bands_for(threshold, 0.999)
        assert bands * rows <= ngram_join.HASHES and 1 - (1 - threshold**rows) ** bands >= 0.999
        # one row more would not fit
        assert 1 - (1 - threshold ** (rows + 1)) ** (ngram_join.HASHES // (rows + 1)) < 0.999
    assert ngram_join.bands_for(1.0) == (1, ngram_join.HASHES)


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(500, 500)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    want = sorted((x, root(x)) for x in parent if any(x in e and e[0] != e[1] for e in edges))
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination


def plain_leaks(docs, items):
    def shingles(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {n: [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] for n in range(1, 6)}, len(words)

    best = {}
    known = {}
    for i, t in items:
        found, m = shingles(t)
        if m:
            known.setdefault(i, []).append((min(m, 5), found[min(m, 5)]))
    for d, t in docs:
        grams = shingles(t)[0]
        for i, n, item in ((i, *x) for i, more in known.items() for x in more):
            own = grams[n]
            if not set(item) & set(own):
                continue
            want = Counter(item)
            for s in range(1 - len(item), len(own)):
                window = Counter(own[max(0, s) : max(0, s + len(item))])
                common = sum((window & want).values())
                value = common / (sum(window.values()) + len(item) - common)
                if value >= 0.8:
                    best[d, i] = max(best.get((d, i), 0), value)
    return best


def leaking():
    items = [(i, prose(300 + i, 20 + 7 * i)) for i in range(8)]
    items += [(8, "q " * 12 + prose(320, 20)), (9, "too short here"), (None, prose(333, 30)), (11, None)]
    rows = [(n, f"{prose(400 + n, 80)} {(t or '').upper()}, {prose(450 + n, 50)}") for n, (_, t) in enumerate(items)]
    rows += [(50 + i, f"Intro: {t.replace(' ', '  ', 3)}.") for i, t in items[:4]]
    rows += [(70 + i, f"{prose(800 + i, 30)} {edited(t, 50, i)} {prose(850 + i, 30)}") for i, t in items[4:9]]
    rows += [(90 + i, " ".join(t.split()[: len(t.split()) // 2])) for i, t in items[:8]]
    return rows, items


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_decontamination(spark, odd, limit):
    rows, items = leaking()
    # a long text that repeats one word, and an odd row
    rows += [(200, "q " * 900), (None, items[2][1]), (201, None)]
    bench = spark.createDataFrame(items * 2, "item_id long, text string").selectExpr("*", "1 AS m", "2 AS item", "3 AS block")
    docs = spark.createDataFrame(rows + rows[:3], DOCS).selectExpr("*", "1 AS shingles", "2 AS start", "3 AS hash", "4 AS window")
    got = decontaminate.leaks(docs, bench, broadcast_rows=limit).collect()
    want = plain_leaks(rows, items)
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) == len(want) and {r["doc_id"] for r in got} >= {*range(9), 50, 51, 52, 53}
    assert {d for d, i in want if i == 9} == {9} and decontaminate.leaks(odd, bench, broadcast_rows=limit).count() == 0


def test_short_items(spark, odd):
    rows = [
        (1, "one TWO, three four five"), (2, "two three"), (2, "two three"), (3, "one"), (4, None), (5, "three two one two three"),
        (None, "four"), (6, "twofour two"),
    ]
    items = [(1, "two three"), (2, "Four!"), (3, "one two three four"), (4, ""), (None, "one"), (6, None), (7, "two three"), (7, "five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        got = decontaminate.leaks(docs, bench, broadcast_rows=limit).collect()
        assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in got} == plain_leaks(rows, items) and len(got) == len({r[:2] for r in got})
        assert {r["item_id"]: (r["start_word"], r["n_words"], r["distance"]) for r in got if r["doc_id"] == 5} == {
            1: (3, 2, 0), None: (2, 1, 0), 7: (3, 2, 0)
        }
    assert {r["doc_id"] for r in decontaminate.leaks(odd, spark.createDataFrame([(1, "one two")], items_schema())).collect()} == {10}


def items_schema():
    return "item_id long, text string"


def test_windows_of_edited_items(spark):
    """No window is lost to inserted, deleted or replaced words: the best of each document is that of all windows."""
    rows, items = [], []
    r = random.Random(5)
    for n in range(3000):
        words = prose(20_000 + n, r.randrange(12, 100)).split()
        items.append((n, " ".join(words)))
        for k in range(r.randint(1, 3)):
            at, kind = r.randrange(1, len(words) - 1), r.randrange(3)
            if kind < 2:
                words[at : at + r.choice((0, 1, 1, 2)) * kind] = []
            if kind != 1:
                words[at:at] = [f"new{n}n{k}n{j}" for j in range(r.randint(1, 3))]
        lead, tail = r.choice((0, 9)), r.choice((0, 0, 9))
        rows.append((n, " ".join([prose(40_000 + n, lead), *words, prose(60_000 + n, tail)])))
    want = {}
    for row, item in zip(rows, items, strict=True):
        want |= {d: v for (d, _), v in plain_leaks([row], [item]).items()}
    found = decontaminate.items_of(spark.createDataFrame(items, items_schema()))
    windows = decontaminate.windows_of(spark.createDataFrame(rows, "doc_id long, text string"), decontaminate.anchors_of(found, 0.8, moved=True), 10**6)
    best = windows.join(found, (F.col("doc_id") == F.col("item_id")) & (windows["m"] == found["m"])).groupBy("doc_id").agg(
        F.max(decontaminate.weighted_similarity("window", "item_shingles")).alias("best")
    )
    got = {x["doc_id"]: x["best"] for x in best.filter("best >= 0.8").collect()}
    assert len(want) > 900 and {d: round(v, 9) for d, v in got.items()} == {d: round(v, 9) for d, v in want.items()}


def test_decontamination_of_nothing(spark, nothing, odd):
    items = spark.createDataFrame([(1, prose(1, 120))], "item_id long, text string")
    assert decontaminate.leaks(nothing, items).count() == 0
    assert {r["doc_id"] for r in decontaminate.leaks(odd, items).collect()} == {1, 2, 3, None}
    assert decontaminate.leaks(odd, items.limit(0)).count() == 0


def test_fingerprint_blocks(spark):
    rows = [(list(map(int, np.random.default_rng(i).integers(-(2**63), 2**63 - 1, 9 + i))),) for i in range(20)]
    df = spark.createDataFrame(rows, "s array<long>").select("s", decontaminate.fingerprint("s").alias("f"))
    for r in df.collect():
        bits = [sum(x >> b & 1 for x in r["s"]) * 2 > len(r["s"]) for b in range(64)]
        assert r["f"] % 2**64 == sum(1 << b for b, on in enumerate(bits) if on)


# --- WARC


def plain_warc(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        again = p in first and (i is None or i > first[p])
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [warc.BROADCAST_ROWS, 0])
def test_warc(spark, limit):
    page = "<p>é" * 40
    rows = [
        (5, "http://a/1", page), (3, "http://a/2", page), (9, None, page), (9, None, page), (None, "u", page), (3, "x", page),
        (1, "http://b", "short"), (2, "http://c", "short"), (4, "bad\r\nWARC-Type: revisit", None), (6, "http://d", ""),
        (7, "http://e", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\nContent-Length: 3\r\n\r\n" * 9 + "\r\n"),
        (8, "http://f", "\r\n\r\n" + "x" * 300_000 + "\n\r\n\r\n"), (None, None, "y" * 200), (None, None, "y" * 200), (None, None, None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS payload", "3 AS value")
    got = warc.revisit_table(pages.repartition(3), broadcast_rows=limit)
    assert by_row(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == plain_warc(rows)


def test_warc_files(spark, tmp_path):
    rows = [(1, "http://a", "é" * 80), (2, "http://b", "é" * 80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archive = warc.write_archives(pages, str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    kinds = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
        kinds.append(fields[b"WARC-Type"])
        data = rest[size + 4 :]
    assert sorted(kinds) == [b"response", b"revisit"]
    assert by_row(warc.read_archives(spark, archive), "url", "payload") == [("http://a", "é" * 80), ("http://b", None)]


def test_warc_cut_record_raises(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "abc")], "page_id long, url string, html string").coalesce(1)
    archive = warc.write_archives(pages, str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*"))
    part.write_bytes(part.read_bytes()[:-6])
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.write_bytes(b"")
    with pytest.raises(Exception, match="cut or malformed|[Cc]hecksum"):
        warc.read_archives(spark, archive).collect()


def test_warc_of_nothing(spark):
    assert warc.revisit_table(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
