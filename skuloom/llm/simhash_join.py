"""SimHash near-duplicates: components of fingerprints within a Hamming distance, found by pigeonring filtering.

1. Every text gets a 64-bit SimHash of its word shingles, repeats included; rows are reduced to distinct fingerprints.
2. A fingerprint is a ring of `SEGMENTS` segments. If two differ in at most d bits, there is a segment from which every chain
   of l consecutive segments, for all l, differs in at most l * d / SEGMENTS bits (pigeonring: were each start to exceed
   its share somewhere, the chains that do so would cover the ring and sum up to more than d). So the first segments of that
   chain agree, and few of the following ones differ at all. `patterns` lists, for every start, the ways to leave out those
   that may differ; two fingerprints within the distance agree on the rest of at least one pattern and meet in its bucket.
   Longer chains give more patterns of more bits: the chain grows with the number of fingerprints, so that chance
   meetings stay few. It changes the work, never the result.
3. In a bucket, the differences of a pair are summed along the chain and the pair is dropped at the first length whose share
   they exceed; the last length is the whole ring, the full Hamming check. Pairs are never written: each group of buckets
   passes on one edge per fingerprint to the smallest it is connected with. A bucket of more than `TILE` fingerprints is
   dealt into tiles, and every pair of tiles is a group of its own.
4. Components over these edges, then the smallest doc_id of each.

A null text is empty. Texts without words have the fingerprint 0 and link like others. Texts of fewer words than a shingle
have one shingle of all of them. Repeated rows give a row each. A null doc_id comes after all others: a component of rows
without ids has a null id. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.common import checkpointed, light_batches, slices, text_or_empty, thrifty
from skuloom.llm.components import components

BITS = 64
NGRAM = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 16
#: Fingerprints per possible value of a bucket's bits, above which chains grow longer.
LOAD = 4
#: Fingerprints of a tile, rows compared in one call, shingles hashed at once.
TILE = 4096
PART_ROWS = 400_000
BLOCK = 1 << 16
#: Buckets up to this size are compared side by side.
SMALL = 32

BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, n: int = NGRAM) -> Iterator[np.ndarray]:
    """XXH64 of the shingles in blocks; words are split at ASCII white space, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(n, len(words))
    firsts, lasts = starts[: len(words) - k + 1], ends[k - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(firsts), BLOCK):
        spans = zip(firsts[at : at + BLOCK].tolist(), lasts[at : at + BLOCK].tolist(), strict=True)
        yield np.array([digest(data[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: bytes, n: int = NGRAM) -> int:
    """Bit i is 1 if it is 1 in more than half of the hashes."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, n):
        by_byte = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.bincount((by_byte + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
        ones += (counts @ BYTE_BITS).ravel()
        total += len(hashes)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def budget(length: int, distance: int = DISTANCE, segments: int = SEGMENTS) -> int:
    """Bits in which a chain of this length may differ."""
    return length * distance // segments


def reach(left_out: int, distance: int = DISTANCE, segments: int = SEGMENTS) -> int:
    """The longest chain that may differ in `left_out` bits."""
    return -(-(left_out + 1) * segments // distance) - 1


def left_out_for(n: int, distance: int = DISTANCE, segments: int = SEGMENTS) -> int:
    """The fewest left-out segments with which n fingerprints meet by chance rarely."""
    for k in range(distance):
        bits = (reach(k, distance, segments) - k) * (BITS // segments)
        if n <= LOAD << bits:
            return k
    return distance - 1


def patterns(left_out: int, distance: int = DISTANCE, segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(start, mask) of the buckets: a chain from every start, without segments that may differ, in all ways to choose them."""
    width, length = BITS // segments, reach(left_out, distance, segments)
    found = []
    for chosen in combinations(range(length), left_out):
        # the i-th segment that differs lies where i bits are allowed
        if all(budget(place + 1, distance, segments) > i for i, place in enumerate(chosen)):
            found.append([p for p in range(length) if p not in chosen])
    one = (1 << width) - 1
    return [
        (start, sum(one << (start + p) % segments * width for p in places)) for start in range(segments) for places in found
    ]


def near(differing: np.ndarray, starts: np.ndarray, distance: int = DISTANCE, segments: int = SEGMENTS) -> np.ndarray:
    """Which XORs of two fingerprints stay within every share of the chain from their start, up to the whole ring."""
    width = np.uint64(BITS // segments)
    turn = starts.astype(np.uint64) * width
    x = differing >> turn | differing << (np.uint64(BITS) - turn) % np.uint64(BITS)
    alive, total, one = np.arange(len(x)), np.zeros(len(x), np.int64), np.uint64((1 << int(width)) - 1)
    for length in range(1, segments + 1):
        total += np.bitwise_count(x & one)
        kept = total <= budget(length, distance, segments)
        alive, x, total = alive[kept], x[kept] >> width, total[kept]
        if not len(alive):
            break
    return alive


def small_links(prints: np.ndarray, bucket: np.ndarray, starts: np.ndarray, **ring) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked rows (i, j) of buckets, whose rows lie side by side: every row with its k-th successor, for all k at a time."""
    rows = np.arange(len(prints))
    k = 0
    while len(rows):
        k += 1
        rows = rows[rows + k < len(prints)]
        rows = rows[bucket[rows] == bucket[rows + k]]
        found = rows[near(prints[rows] ^ prints[rows + k], starts[rows], **ring)]
        yield found, found + k


def large_links(prints: np.ndarray, start: int, **ring) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what all links of one bucket connect: each row is compared with those not reached yet."""
    unseen = np.arange(len(prints))
    while len(unseen):
        front, unseen = [unseen[0]], unseen[1:]
        while front and len(unseen):
            at = front.pop()
            mates = near(prints[unseen] ^ prints[at], np.full(len(unseen), start), **ring)
            yield np.full(len(mates), at), unseen[mates]
            front += unseen[mates].tolist()
            unseen = np.delete(unseen, mates)


def least_connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest that the links (i, j) connect it with."""
    label = np.arange(n)
    while True:
        told = label.copy()
        np.minimum.at(told, i, label[j])
        np.minimum.at(told, j, label[i])
        # a label's own label is as good
        told = np.minimum(told, told[told])
        if (told == label).all():
            return label
        label = told


def compare(rows: pa.Table, **ring) -> pa.Table:
    """(a, b): per fingerprint of the group one edge to the smallest that links of the group connect it with."""
    columns = [rows[c].to_numpy() for c in ("print", "start", "b", "a", "bucket")]
    order = np.lexsort(columns)
    prints, *groups = (c[order] for c in columns)
    prints, starts = prints.astype(np.int64).view(np.uint64), groups[0]
    new = np.append(True, np.any([np.diff(g) != 0 for g in groups], axis=0)) if len(order) else np.zeros(0, bool)
    bucket = np.cumsum(new)
    sizes = np.bincount(bucket)[bucket]
    values, node = np.unique(prints, return_inverse=True)
    pairs = []
    small = sizes <= SMALL
    for i, j in small_links(prints[small], bucket[small], starts[small], **ring):
        pairs.append((node[small][i], node[small][j]))
    for at in np.flatnonzero(new & ~small).tolist():
        own = slice(at, at + int(sizes[at]))
        pairs += [(node[own][i], node[own][j]) for i, j in large_links(prints[own], int(starts[at]), **ring)]
    empty = np.zeros(0, np.int64)
    i, j = (np.concatenate([empty, *side]) for side in (zip(*pairs) if pairs else ((), ())))
    first = least_connected(len(values), i, j)
    moved = np.flatnonzero(first != np.arange(len(values)))
    return pa.table({"a": pa.array(values[moved].view(np.int64)), "b": pa.array(values[first[moved]].view(np.int64))})


def links(
    prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, left_out: int | None = None, tile: int = TILE,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(a, b) of fingerprints: edges that connect what all pairs within the distance connect. `prints` has distinct ones."""
    if left_out is None:
        left_out = left_out_for(prints.count(), distance, segments)
    listed = patterns(left_out, distance, segments)
    # masks as signed numbers, as Spark has them
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for _, m in listed])
    starts = F.array(*[F.lit(s).cast("short") for s, _ in listed])
    at = F.posexplode(F.transform(masks, lambda m: F.xxhash64(m, F.col("print").bitwiseAND(m)))).alias("pattern", "bucket")
    placed = prints.select("print", at).select("print", "bucket", F.get(starts, F.col("pattern")).alias("start"))
    # from a written table, so that Spark can split a bucket that many share in the join
    shared = checkpointed(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    tiles = F.ceil(F.col("n") / tile).cast("int")
    sent = shared.agg(F.sum(F.col("n") * tiles)).first()[0] or 0
    met = placed.join(shared, "bucket").withColumn("tiles", tiles)
    met = met.withColumn("own", F.pmod(F.xxhash64("print", F.lit(1)), F.col("tiles")).cast("int")).select(
        "print", "bucket", "start", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    )
    met = met.select("print", "bucket", "start", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    part = F.pmod(F.xxhash64("bucket", "a", "b"), F.lit(max(1, math.ceil(sent / part_rows))))
    ring = {"distance": distance, "segments": segments}
    return met.withColumn("part", part).groupBy("part").applyInArrow(thrifty(lambda t: compare(t, **ring)), "a long, b long")


def fingerprints(docs: DataFrame, n: int = NGRAM) -> DataFrame:
    """(doc_id, print) of every row; the fingerprint as a signed 64-bit number."""
    rows = light_batches(docs).select("doc_id", text_or_empty().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, n) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "print"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"]]).add("print", "long"))


def near_duplicates(docs: DataFrame, n: int = NGRAM, **search) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; `search` goes to `links`."""
    signed = checkpointed(fingerprints(docs, n))
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    prints = checkpointed(signed.groupBy("print").agg(F.min(own).alias("least")))
    roots = components(links(prints.select("print"), **search), written=True).withColumnRenamed("node", "print")
    linked = prints.join(roots, "print")
    best = linked.groupBy("root").agg(F.min("least").alias("best"))
    # both from written tables, so that Spark can split a component of very many fingerprints
    placed = checkpointed(linked.select("print", "root")).join(checkpointed(best), "root").select("print", "best")
    told = prints.join(placed, "print", "left").select("print", F.coalesce("best", "least")["id"].alias("component_id"))
    return signed.join(checkpointed(told), "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
