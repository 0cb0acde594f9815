"""Removal of byte strings that an earlier document holds.

A byte goes if a 50-byte string over it also starts in a document with a smaller id; strings are judged on the input and
never cross documents. Documents are dealt into chunks of bounded size, the shards, and everything runs shard by shard:

1. Whole copies of an earlier text are found by digest. They go as a whole and take no further part.
2. Each shard sends the keys of its windows (`suffixes.keys`: equal windows, equal keys), each distinct key once and cut
   to 32 bits, to buckets, which answer with a bit per key: does another shard have it? Wrong bits cost time only.
3. Each shard sorts the windows with a shared key into a suffix array (Larsson-Sadakane refinement), finds equal ones by
   their common prefixes (Kasai) and settles those of which the shard itself has an earlier one. However often a string
   stands in a shard, only its first document goes on.
4. What is left goes as byte fragments to the bucket of its key. There the shards are merged: the distinct windows are
   sorted, each shard's windows are located among them by binary search, and the smallest id of each is known.
5. Each shard gets its removed ranges and cuts its texts.

The texts are shuffled once; the three passes over a shard read the same exchange. Shards, buckets and ranges follow from
hashes of the rows, so a task that runs again gives the same rows. Nothing is collected, and no group grows with the
corpus but the number of shards that hold one string.

Null text counts as empty. A null id counts as larger than all others; rows with the same id never remove anything from
one another. Texts under 50 bytes are kept. Repeated rows each give a row. Further columns are ignored. Ids are integers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm import suffixes as S
from skuloom.llm.common import LAST, checkpointed, light_batches, text_or_empty, thrifty, total_bytes

CHUNK_BYTES = 4_000_000
#: Input bytes per bucket of keys and of fragments.
KEY_BYTES, FRAGMENT_BYTES = 16_000_000, 4_000_000
ODD = np.uint64(0xFF51AFD7ED558CCD)
COPY, SHARED, RANGES = 0, 1, 2
NOTE = "chunk long, kind int, bucket long, data binary"


def pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers, compressed."""
    raw = np.concatenate([[len(columns[0])], *columns]).astype("<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> np.ndarray:
    """A row per column."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")
    return raw[1:].reshape(-1, raw[0]) if raw[0] else np.zeros((4, 0), np.int64)


@dataclass
class Shard:
    """The documents of a chunk in a fixed order, and the text of those that take part."""

    ids: np.ndarray
    texts: list[bytes]
    copied: np.ndarray
    data: np.ndarray
    #: Of the documents in `data`: their place in `ids` and where they start.
    places: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table, notes: pa.Table) -> Shard:
        copies: set[tuple[int, int]] = set()
        for kind, data in zip(notes["kind"].to_pylist(), notes["data"].to_pylist(), strict=True):
            if kind == COPY:
                copies.update(zip(*unpack(data).tolist(), strict=True))
        docs = sorted(
            zip(rows["rank"].to_pylist(), map(str.encode, rows["text"].to_pylist()), rows["hash"].to_pylist(), strict=True)
        )
        copied = np.array([(i, h) in copies for i, _, h in docs], bool)
        places = np.array([k for k, d in enumerate(docs) if not copied[k] and len(d[1]) >= S.WINDOW], np.int64)
        texts = [d[1] for d in docs]
        data = np.frombuffer(b"".join(texts[k] for k in places), np.uint8)
        sizes = np.array([len(texts[k]) for k in places], np.int64)
        return cls(np.array([d[0] for d in docs], np.int64), texts, copied, data, places, np.cumsum(sizes) - sizes)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """`words` of the data; start, owner and key of every window."""
        x = S.words(self.data)
        sizes = S.lengths(self.starts, len(self.data))
        owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - S.WINDOW + 1, 0))
        counts = sizes - S.WINDOW + 1
        at = np.arange(len(owner)) + np.repeat(self.starts - (np.cumsum(counts) - counts), counts)
        return x, at, owner, S.keys(x, len(self.data))[at]


def dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 further bits of each key."""
    mixed = keys * ODD
    mixed ^= mixed >> np.uint64(32)
    n = np.uint64(buckets)
    return (mixed % n).astype(np.int64), (mixed // n).astype(np.uint32)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of distinct keys by bucket and bits, and these; keys with the same bits in a bucket get the same answer."""
    bucket, bits = dealt(keys, buckets)
    order = np.argsort(bucket.astype(np.uint64) << np.uint64(32) | bits)
    return order, bucket[order], bits[order]


def notes(chunk: list[int], kind: int, bucket: list[int], data: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "chunk": pa.array(chunk, pa.int64()), "kind": pa.array([kind] * len(chunk), pa.int32()),
            "bucket": pa.array(bucket, pa.int64()), "data": pa.array(data, pa.binary()),
        }
    )


def ranges_of(places: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, sorted by document and start, as (document, first byte, end) of the bytes that runs of them cover."""
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(at), bool)
    new[1:] = (places[1:] != places[:-1]) | (at[1:] > at[:-1] + S.WINDOW)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return places[first], at[first], at[last] + S.WINDOW


def settle(shard: Shard, answers: pa.Table, key_buckets: int, buckets: int) -> tuple[bytes, dict[int, bytes]]:
    """Ranges that the shard settles itself, and the fragments that go to the buckets."""
    x, at, owner, keys = shard.windows()
    first = S.runs(keys, owner)
    run_keys, run_owner, run_sizes = keys[first], owner[first], S.lengths(first, len(keys))
    found, slot = S.classes(run_keys)
    placed, bucket, _ = by_bucket(found, key_buckets)
    elsewhere = np.zeros(len(found), bool)
    ends = np.searchsorted(bucket, np.arange(key_buckets + 1))
    for kind, b, data in zip(*(answers[c].to_pylist() for c in ("kind", "bucket", "data")), strict=True):
        if kind == SHARED:
            own = placed[ends[b] : ends[b + 1]]
            elsewhere[own] = np.unpackbits(np.frombuffer(data, np.uint8), count=len(own))
    # keys that two documents of the shard have
    pairs = np.sort(slot * max(1, len(shard.places)) + run_owner)
    inside = np.bincount(pairs[S.runs(pairs)] // max(1, len(shard.places)), minlength=len(found)) > 1
    wanted = np.repeat((elsewhere | inside)[slot], run_sizes)
    at, owner, keys, abroad = at[wanted], owner[wanted], keys[wanted], np.repeat(elsewhere[slot], run_sizes)[wanted]
    if not len(at):
        return pack(*ranges_of(at, at)), {}
    # only the bytes of these windows
    _, first, end = ranges_of(np.zeros(len(at), np.int64), at)
    edge = np.zeros(len(shard.data) + 1, np.int8)
    edge[first] = 1
    edge[end] -= 1
    used = np.cumsum(edge[:-1], dtype=np.int8) > 0
    small = x[: len(shard.data)][used]
    picked = (np.cumsum(used) - 1)[at]
    number = np.empty(len(small), np.int64)
    number[picked] = np.arange(len(picked))
    order = S.suffix_order(small, picked)
    new = S.common_prefixes(small, order) < S.WINDOW
    new[0] = True
    index = number[order]
    ids = shard.ids[shard.places[owner]]
    groups = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[index], groups)
    settled = np.zeros(len(at), bool)
    settled[index] = ids[index] > np.repeat(least, S.lengths(groups, len(order)))
    local = pack(*ranges_of(shard.places[owner[settled]], (at - shard.starts[owner])[settled]))
    left = ~settled & abroad
    at, owner, keys = at[left], owner[left], keys[left]
    if not len(at):
        return local, {}
    # neighbours with one key make a fragment
    step = np.ones(len(at), np.int64)
    step[1:] = at[1:] - at[:-1]
    first = S.runs(keys, owner, np.cumsum(step != 1))
    counts = S.lengths(first, len(at))
    target = dealt(keys[first], buckets)[0]
    order = np.argsort(target, kind="stable")
    first, counts, target = first[order], counts[order], target[order]
    sent = {}
    for lo, hi in zip(p := S.runs(target), np.append(p[1:], len(target)), strict=True):
        f, c = first[lo:hi], counts[lo:hi]
        head = np.concatenate([[hi - lo], shard.places[owner[f]], at[f] - shard.starts[owner[f]], c, shard.ids[shard.places[owner[f]]]])
        body = [shard.data[a : a + n + S.WINDOW - 1].tobytes() for a, n in zip(at[f].tolist(), c.tolist(), strict=True)]
        sent[int(target[lo])] = zstandard.ZstdCompressor(level=3).compress(head.astype("<i8").tobytes() + b"".join(body))
    return local, sent


def merge(chunks: list[int], blobs: list[bytes]) -> dict[int, tuple[np.ndarray, ...]]:
    """Removed ranges of each shard from the fragments of all shards in a bucket."""
    heads, numbers, firsts = [], {}, []
    which = []
    for k, blob in enumerate(blobs):
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        head = np.frombuffer(raw, "<i8", 4 * n, 8).reshape(4, n)
        at = 8 + 32 * n
        own = np.empty(n, np.int64)
        for i, c in enumerate(head[2].tolist()):
            part = raw[at : at + c + S.WINDOW - 1]
            at += len(part)
            f = numbers.setdefault(part, len(numbers))
            if f == len(firsts):
                firsts.append(LAST)
            own[i] = f
        which.append(own)
        heads.append(np.concatenate([np.full((1, n), k), head]))
    shard, place, start, count, ids = np.concatenate(heads, 1)
    fragment = np.concatenate(which)
    least = np.full(len(numbers), LAST)
    np.minimum.at(least, fragment, ids)
    # a fragment that no other with its key differs from is settled as a whole
    text = np.frombuffer(b"".join(numbers), np.uint8)
    sizes = np.array([len(f) for f in numbers], np.int64)
    begins = np.cumsum(sizes) - sizes
    _, slot = S.classes(S.keys(S.words(text), len(text))[begins])
    varied = np.bincount(slot)[slot] > 1
    # of the others, every window is looked up among the distinct ones
    n_windows = sizes - S.WINDOW + 1
    offsets = np.cumsum(n_windows) - n_windows
    smallest = np.repeat(least, n_windows)
    where = np.flatnonzero(np.repeat(varied, n_windows))
    if len(where):
        own = np.repeat(np.arange(len(sizes)), n_windows)[where]
        strings = np.lib.stride_tricks.sliding_window_view(text, S.WINDOW)[begins[own] + where - offsets[own]]
        strings = np.ascontiguousarray(strings).view(f"S{S.WINDOW}").ravel()
        merged = np.unique(strings)
        found = np.searchsorted(merged, strings)
        best = np.full(len(merged), LAST)
        np.minimum.at(best, found, least[own])
        smallest[where] = best[found]
    # every shard's windows: removed where an earlier document has the string
    row = np.repeat(np.arange(len(fragment)), count)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    gone = smallest[offsets[fragment[row]] + inner] < ids[row]
    row, inner = row[gone], inner[gone]
    # as the shards follow one another and each sent its fragments in order, so do the windows: one pass serves all shards
    shard, place, at = shard[row], place[row], start[row] + inner
    docs = S.runs(shard, place)
    doc, begin, end = ranges_of(np.repeat(np.arange(len(docs)), S.lengths(docs, len(row))), at)
    shard, place = shard[docs][doc], place[docs][doc]
    first = S.runs(shard)
    return {
        chunks[shard[lo]]: (place[lo:hi], begin[lo:hi], end[lo:hi])
        for lo, hi in zip(first.tolist(), np.append(first[1:], len(shard)).tolist(), strict=True)
    }


def cut(shard: Shard, answers: pa.Table) -> tuple[list[list[tuple[int, int]]], list[bytes]]:
    """Removed spans and the rest of every document."""
    found = [unpack(d) for k, d in zip(answers["kind"].to_pylist(), answers["data"].to_pylist(), strict=True) if k == RANGES]
    found = [f[:3] for f in found if f.shape[1]]
    place, start, end = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((end, start, place))
    spans: list[list[tuple[int, int]]] = [[(0, len(t))] if c else [] for t, c in zip(shard.texts, shard.copied, strict=True)]
    for p, a, b in zip(place[order].tolist(), start[order].tolist(), end[order].tolist(), strict=True):
        own = spans[p]
        if own and a <= own[-1][1]:
            own[-1] = (own[-1][0], max(b, own[-1][1]))
        else:
            own.append((a, b))
    rest = []
    for text, own in zip(shard.texts, spans, strict=True):
        edges = [0, *(x for span in own for x in span), len(text)]
        rest.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if own else text)
    return spans, rest


def whole_copies(docs: DataFrame) -> DataFrame:
    """(chunk, ...) notes on rows of (rank, text, hash, chunk) whose text a row with a smaller rank has."""
    told = docs.filter(F.octet_length("text") >= S.WINDOW).select("rank", "hash", "chunk", F.sha2("text", 256).alias("digest"))
    firsts = told.groupBy("digest").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # from a written table, so that Spark can split a digest with very many rows in the join
    later = told.join(checkpointed(firsts.drop("n")), "digest").filter(F.col("rank") > F.col("first"))

    def gather(rows: pa.Table) -> pa.Table:
        pairs = sorted(set(zip(rows["rank"].to_pylist(), rows["hash"].to_pylist(), strict=True)))
        columns = np.array(pairs, np.int64).T
        return notes([rows["chunk"][0].as_py()], COPY, [0], [pack(*columns)])

    return later.select("chunk", "rank", "hash").groupBy("chunk").applyInArrow(thrifty(gather), NOTE)


def remove_repeats(
    docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, key_bytes: int = KEY_BYTES, fragment_bytes: int = FRAGMENT_BYTES
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed byte ranges, and the remaining bytes."""
    total = total_bytes(docs)
    chunks, key_buckets, buckets = (max(1, math.ceil(total / size)) for size in (chunk_bytes, key_bytes, fragment_bytes))
    text = text_or_empty()
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    chunked = light_batches(docs).select(
        rank.alias("rank"), text.alias("text"), F.xxhash64(text).alias("hash"),
        F.pmod(F.xxhash64(rank, text), F.lit(chunks)).cast("long").alias("chunk"),
    )
    copies = checkpointed(whole_copies(chunked))

    def ask(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return notes([], SHARED, [], [])
        shard = Shard.of(rows, known)
        _, _, owner, keys = shard.windows()
        _, bucket, bits = by_bucket(S.classes(keys[S.runs(keys, owner)])[0], key_buckets)
        first = S.runs(bucket)
        parts = [p.astype("<u4").tobytes() for p in np.split(bits, first[1:])] if len(bits) else []
        chunk = rows["chunk"][0].as_py()
        return notes([chunk] * len(parts), SHARED, bucket[first].tolist(), parts)

    def compare(rows: pa.Table) -> pa.Table:
        lists = [np.frombuffer(d, "<u4") for d in rows["data"].to_pylist()]
        # sorted lists, in which a value may stand twice
        values = np.sort(np.concatenate([b[S.runs(b)] for b in lists]))
        first = S.runs(values)
        shared = values[first[S.lengths(first, len(values)) > 1]]
        masks = [shared[np.searchsorted(shared, b).clip(max=len(shared) - 1)] == b if len(shared) else np.zeros(len(b), bool) for b in lists]
        told = [(c, np.packbits(m).tobytes()) for c, m in zip(rows["chunk"].to_pylist(), masks, strict=True) if m.any()]
        bucket = rows["bucket"][0].as_py()
        return notes([c for c, _ in told], SHARED, [bucket] * len(told), [m for _, m in told])

    def send(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return notes([], RANGES, [], [])
        chunk = rows["chunk"][0].as_py()
        local, sent = settle(Shard.of(rows, known), known, key_buckets, buckets)
        # what the shard has settled takes the same way, in a bucket of its own
        return notes([chunk] * (1 + len(sent)), RANGES, [-1 - chunk, *sent], [local, *sent.values()])

    def answer(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() < 0:
            return rows.select(["chunk", "kind", "bucket", "data"])
        # the order of the shards, and with it the result, does not depend on the shuffle
        pairs = sorted(zip(rows["chunk"].to_pylist(), rows["data"].to_pylist(), strict=True))
        found = merge([c for c, _ in pairs], [d for _, d in pairs])
        return notes(list(found), RANGES, [0] * len(found), [pack(*r) for r in found.values()])

    def finish(rows: pa.Table, known: pa.Table) -> pa.Table:
        shard = Shard.of(rows, known) if rows.num_rows else None
        spans, rest = cut(shard, known) if shard else ([], [])
        ids = [None if i == LAST else i for i in shard.ids.tolist()] if shard else []
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_bytes": pa.array([len(t) for t in shard.texts] if shard else [], pa.int64()),
                "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind),
                "kept": pa.array(rest, pa.binary()),
            }
        )

    def told(more: DataFrame) -> DataFrame:
        return copies.unionByName(more)

    by_chunk = chunked.groupBy("chunk")
    asked = by_chunk.cogroup(copies.groupBy("chunk")).applyInArrow(thrifty(ask), NOTE)
    shared = asked.groupBy("bucket").applyInArrow(thrifty(compare), NOTE)
    sent = by_chunk.cogroup(told(shared).groupBy("chunk")).applyInArrow(thrifty(send), NOTE)
    answers = sent.groupBy("bucket").applyInArrow(thrifty(answer), NOTE)
    span = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
    result = T.StructType().add("doc_id", "long").add("n_bytes", "long").add("spans", span).add("kept", "binary")
    return by_chunk.cogroup(told(answers).groupBy("chunk")).applyInArrow(thrifty(finish), result)


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
