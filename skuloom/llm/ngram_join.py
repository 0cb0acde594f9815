"""Similarity join on word n-grams: MinHash banding, verified on the full sets.

1. Every text becomes the set of its distinct five-word shingles. Texts with the same set form a class, of which one
   document goes on; its copies are counted, never compared.
2. The set's MinHash signature is cut into bands; their number and rows are chosen so that a pair at the threshold shares
   a band with probability `RECALL`. Band hashes are shuffled and buckets with one class dropped. Buckets with the same
   members are needed once.
3. The sets of classes in a bucket meet there and are compared in full, pairs at a time as a product of incidence
   matrices. A bucket over `TILE` classes is dealt into tiles, and every pair of tiles is a task of its own. Pairs are
   never written: a class gets its number of links, each pair counted in the first bucket that the two share, and one
   edge to the smallest class that links of this tile pair connect it with, so that all they connect stays connected.
4. Components over those edges give the class ids.

Null text counts as empty. A text without words has links with nothing, not even its like, and is a class of its own.
Repeated rows are copies of one another. Null ids sort last; a class of null ids only has a null class id. Further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.common import LAST, checkpointed, light_batches, slices, text_or_empty, thrifty
from skuloom.llm.components import components
from skuloom.llm.shingles import WordHashes, shingle_set

THRESHOLD = 0.8
RECALL = 0.9995
#: Most hashes of a signature; the most rows a band can then have are taken, as they keep chance matches down.
HASHES = 128
TILE = 512
#: Bytes of sets compared in one call.
PART_BYTES = 8_000_000
#: Bytes of sets in a batch that is sent.
SENT_BYTES = 4_000_000


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows a band): the most rows with which the recall is reached."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        met = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-met)) if 0 < met < 1 else hashes * (met == 0) + 1
        if bands * rows <= hashes:
            best = (bands, rows)
    return best


def permutations(n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    odd = random.integers(1, 1 << 63, n, np.uint64) << np.uint64(1) | np.uint64(1)
    return odd, random.integers(0, 1 << 63, n, np.uint64)


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash per band, different between bands."""
    odd, add = permutations(bands * rows)
    least = np.empty(bands * rows, np.uint64)
    for at in range(0, len(least), 20):
        h = shingles[:, None] * odd[at : at + 20] + add[at : at + 20]
        h ^= h >> np.uint64(32)
        least[at : at + 20] = h.min(0)
    found = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        found = (found ^ least[r::rows]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(32)
    return found.astype(np.int64)


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """(doc_id, rank, hash, key, bands) of every row; key and bands are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            keys, found = [], []
            for text in batch.column(3).to_pylist():
                s = shingle_set(text, hashes)
                keys.append(set_key(s))
                found.append(band_hashes(s, bands, per_band) if len(s) else None)
            columns = [*batch.columns[:3], pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "rank", "hash", "key", "bands"])

    kept = rows.select("doc_id", "rank", "hash", "text")
    result = T.StructType(kept.schema.fields[:3]).add("key", "binary").add("bands", T.ArrayType(T.LongType()))
    return kept.mapInArrow(run, result)


def members(classes: DataFrame) -> DataFrame:
    """(key, buckets): the buckets worth comparing of each class, an array of (bucket, n) with null for bands without one."""
    placed = classes.select("key", F.posexplode("bands").alias("band", "bucket"))
    sizes = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("least"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("xor"),
    ).filter("n > 1")
    needed = sizes.groupBy("n", "least", "sum", "xor").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    # at most one entry a band
    return placed.join(needed, "bucket").groupBy("key").agg(F.collect_list(F.struct("band", "bucket", "n")).alias("buckets"))


class Sets:
    """The classes of one tile pair."""

    def __init__(self, rows: list[tuple]) -> None:
        self.keys = [r[0] for r in rows]
        self.copies = np.array([r[1] for r in rows], np.int64)
        self.tiles = np.array([r[2] for r in rows], np.int64)
        self.buckets = np.array([r[3] for r in rows], np.int64).reshape(len(rows), -1)
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        self.sizes = np.array(list(map(len, sets)), np.int64)
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(rows)), self.sizes)
        _, column, uses = np.unique(every, return_inverse=True, return_counts=True)
        # shingles of one class are in no intersection
        common = uses[column] > 1
        _, self.column = np.unique(column[common], return_inverse=True)
        self.owner = owner[common]
        by = np.argsort(self.column, kind="stable")
        self.owner, self.column = self.owner[by], self.column[by]

    def intersections(self, width: int = 4096) -> np.ndarray:
        """Sizes of the intersections of all pairs."""
        n = len(self.keys)
        found = np.zeros((n, n), np.float32)
        total = int(self.column[-1]) + 1 if len(self.column) else 0
        for at in range(0, total, width):
            lo, hi = np.searchsorted(self.column, (at, at + width))
            part = np.zeros((n, min(width, total - at)), np.float32)
            part[self.owner[lo:hi], self.column[lo:hi] - at] = 1
            found += part @ part.T
        return found

    def linked(self, bucket: int, a: int, b: int, threshold: float) -> np.ndarray:
        """Which pairs of tiles a and b are links whose first common bucket is this one."""
        common = self.intersections()
        union = self.sizes[:, None] + self.sizes[None, :] - common
        links = common >= threshold * union - 1e-6
        np.fill_diagonal(links, False)
        if a != b:
            links &= self.tiles[:, None] != self.tiles[None, :]
        for column in self.buckets.T:
            earlier = (column != 0) & (column < bucket)
            if earlier.any():
                links &= ~((column[:, None] == column[None, :]) & earlier[:, None])
        return links


def connected(links: np.ndarray) -> np.ndarray:
    """Per row of a symmetric matrix, the first row that links connect it with, itself included."""
    first = np.full(len(links), -1)
    for i in range(len(links)):
        front = np.array([i]) if first[i] < 0 else np.empty(0, int)
        # each row is in front once
        while len(front):
            first[front] = i
            front = np.flatnonzero(links[front].any(0) & (first < 0))
    return first


def compare(rows: pa.Table, threshold: float) -> pa.Table:
    """(key, links, least): per class and tile pair, the documents it is linked with, and the smallest connected class."""
    names = ("bucket", "a", "b")
    groups: dict[tuple, dict[bytes, tuple]] = {}
    for row in zip(*(rows[c].to_pylist() for c in (*names, "key", "n", "tile", "buckets", "shingles")), strict=True):
        # repeated rows give the same class again
        groups.setdefault(row[:3], {})[row[3]] = row[3:]
    keys, links, least = [], [], []
    for (bucket, a, b), own in sorted(groups.items()):
        if len(own) < 2:
            continue
        sets = Sets([own[k] for k in sorted(own)])
        found = sets.linked(bucket, a, b, threshold)
        counts, first = found @ sets.copies, connected(found)
        for i in np.flatnonzero(found.any(1)).tolist():
            keys.append(sets.keys[i])
            links.append(int(counts[i]))
            least.append(sets.keys[first[i]])
    return pa.table({"key": pa.array(keys, pa.binary()), "links": pa.array(links, pa.int64()), "least": pa.array(least, pa.binary())})


def linked_classes(rows: DataFrame, classes: DataFrame, n_bands: int, threshold: float, tile: int, part_bytes: int) -> DataFrame:
    """(key, links, least) of every class with a link, once per tile pair in which it has one."""
    wanted = checkpointed(classes.select("key", "rank", "hash", "n").join(members(classes), "key"))
    # each member is sent with its set, eight bytes a shingle or about 1.3 bytes per byte of text, to every tile pair
    size = F.aggregate("buckets", F.lit(0).cast("long"), lambda s, b: s + F.ceil(b["n"] / tile).cast("long"))
    told = wanted.agg(F.sum(size).alias("m")).first()["m"] or 0
    mean = rows.agg(F.avg(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(told * (1.3 * mean + 300) / part_bytes))

    kinds = {
        "bucket": pa.int64(), "a": pa.int64(), "b": pa.int64(), "key": pa.binary(), "n": pa.int64(), "tile": pa.int64(),
        "buckets": pa.list_(pa.int64()), "shingles": pa.binary(),
    }

    def rows_of(key: bytes, n: int, buckets: list[dict], shingles: bytes) -> Iterator[tuple]:
        """The class, once for every tile pair of its buckets in which it takes part."""
        by_band = [0] * n_bands
        for x in buckets:
            by_band[x["band"]] = x["bucket"]
        for x in buckets:
            tiles = -(-x["n"] // tile)
            own = int.from_bytes(key[:8], "little") % tiles
            for other in range(tiles):
                yield x["bucket"], min(own, other), max(own, other), key, n, own, by_band, shingles

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held: list[tuple] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(v, k) for v, k in zip(zip(*held, strict=True), kinds.values(), strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

        for batch in slices(batches):
            for key, n, buckets, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingle_set(text, hashes)
                if set_key(s) != key:
                    continue
                for row in rows_of(key, n, buckets, s.tobytes()):
                    held.append(row)
                    size += len(row[-1])
                    if size >= SENT_BYTES:
                        yield flushed()
                        size = 0
        if held:
            yield flushed()

    texts = rows.select(F.col("rank").alias("d_rank"), F.col("hash").alias("d_hash"), "text")
    same = (F.col("rank") == F.col("d_rank")) & (F.col("hash") == F.col("d_hash"))
    sent = wanted.join(texts, same).select("key", "n", "buckets", "text").mapInArrow(
        send, "bucket long, a long, b long, key binary, n long, tile long, buckets array<long>, shingles binary"
    )
    part = F.pmod(F.xxhash64("bucket", "a", "b"), F.lit(parts))
    return sent.withColumn("part", part).groupBy("part").applyInArrow(
        thrifty(lambda t: compare(t, threshold)), "key binary, links long, least binary"
    )


def similarity_join(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, tile: int = TILE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(doc_id, rank, hash, set_id, class_id, n_links, first) of every row.

    `class_id` is the smallest id of the documents that links connect, `set_id` of those with the same shingles,
    `n_links` the number of other documents linked with this one, copies included. `first` marks one row of each class:
    of the rows with the smallest id, that with the smallest text hash (`hash`), and all rows that repeat it.
    """
    n_bands, per_band = bands_for(threshold, recall)
    text = text_or_empty()
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    rows = light_batches(docs).select("doc_id", rank.alias("rank"), F.xxhash64(text).alias("hash"), text.alias("text"))
    signed = checkpointed(signatures(rows, n_bands, per_band))
    classes = (
        signed.filter(F.col("key").isNotNull()).groupBy("key")
        .agg(F.min(F.struct("rank", "hash")).alias("least"), F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands"))
        .select("key", "least.rank", "least.hash", "n", "bands")
    )
    found = checkpointed(linked_classes(rows, classes, n_bands, threshold, tile, part_bytes))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("least").alias("b")))
    sets = classes.select("key", F.struct("rank", "hash").alias("own"), "n")
    linked = sets.join(roots.withColumnRenamed("node", "key"), "key")
    smallest = linked.groupBy("root").agg(F.min("own").alias("best"))
    placed = linked.join(smallest, "root").join(links, "key", "left").select("key", "best", "links")
    told = sets.join(placed, "key", "left").select(
        "key", "own", F.coalesce("best", "own").alias("best"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    own_id = F.struct("rank", "hash")
    # from a written table, so that Spark can split a class with very many copies in the join
    result = signed.select("doc_id", "rank", "hash", "key").join(checkpointed(told), "key", "left")

    def shown(column: str):
        found = F.coalesce(F.col(column)["rank"], F.col("rank"))
        return F.when(found < LAST, found)

    return result.select(
        "doc_id", "rank", "hash", shown("own").alias("set_id"), shown("best").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("best").isNull() | (F.col("best") == own_id)).alias("first"),
    )
