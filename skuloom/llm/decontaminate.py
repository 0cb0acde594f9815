"""Benchmark decontamination: documents that hold a benchmark item or nearly so.

Texts are compared as words (runs of letters and digits, in lower case) in shingles of five. A window is as many words of
a document as an item has. Its weighted similarity with the item is the sum over shingles of the smaller number of
occurrences by the sum of the larger; from `THRESHOLD` on the document leaks the item.

1. Windows are cut where they can match. A window of similarity t lacks at most a share 1 - t of the item's shingles, so
   one of any (1 - t) * n + 1 of them stands in it; so many anchors are taken per item, those of least hash, and a window
   is laid where a document has an anchor at one of the anchor's places in the item, and at the starts on both sides to
   which inserted or deleted words can move it (`slack`; none with `moved` off). Windows reaching over an end are clipped.
2. Every window and every item gets a 64-bit SimHash. Fingerprints are cut into 8 blocks of 8 bits; of two within
   `RADIUS` (15) bits one block differs by one bit at most, so blocks with their one-bit neighbours, listed on the side of
   the items, find all fingerprints within the radius.
3. The similarity is computed from the full shingles of window and item.

Step 1 loses no window that holds the item with words replaced, inserted or deleted, at the price of some 2 * (1 - t) * n
windows for one. Where parts of an item change places, it may find a lesser window of it. SimHash is the one step with a chance: at a similarity of
exactly 0.8 about 2 in 100 pairs differ by more than 15 bits, at 0.9 fewer than 1 in 1000, and equal texts never.

An item of one to four words is a single shingle of all its words. A window of as many words is one too: its fingerprint
is the shingle's hash, its similarity 1 or 0. So equal hashes are joined.

Everything is DataFrame expressions. Anchors, blocks of items and the starts of windows are broadcast up to
`BROADCAST_ROWS`, counted first; beyond that both sides are shuffled.

Null texts hold nothing, items without a word are in no text. Null and repeated ids are taken as they are: one row per
distinct pair of document id and item id, the best window of each. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import checkpointed, text_or_empty

NGRAM = 5
THRESHOLD = 0.8
BLOCKS, BLOCK_BITS = 8, 8
RADIUS = 2 * BLOCKS - 1
#: Rows of about 40 bytes.
BROADCAST_ROWS = 300_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def hashed(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and the hashes `h` of the words."""
    split = rows.select(*keep, F.array_remove(F.split(F.lower(text_or_empty()), NOT_WORD), "").alias("words"))
    return split.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))


def grams(n: int) -> Column:
    """The hash of every shingle of n words, in the order of the text (null: none)."""
    starts = F.sequence(F.lit(0), F.size("h") - n)
    return F.when(F.size("h") >= n, F.transform(starts, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(n)])))


def shingled(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep`, the number of words `m`, and the shingles."""
    return hashed(rows, *keep).select(*keep, F.size("h").alias("m"), grams(NGRAM).alias("shingles"))


def fingerprint(shingles: str) -> Column:
    """SimHash: a bit is set where more than half of the shingles, each as often as it occurs, have it."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(
            shingles, F.lit(0).cast("long"), lambda n, x: n + F.call_function("shiftrightunsigned", x, b).bitwiseAND(F.lit(1).cast("long"))
        )
        return F.call_function("shiftleft", (ones * 2 > F.size(shingles)).cast("long"), b)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda bits, b: bits.bitwiseOR(bit(b)))


def block(bits: str | Column, number: Column) -> Column:
    bits = F.col(bits) if isinstance(bits, str) else bits
    return F.call_function("shiftrightunsigned", bits, (number * BLOCK_BITS).cast("int")).bitwiseAND(
        F.lit((1 << BLOCK_BITS) - 1).cast("long")
    )


def weighted_similarity(a: str, b: str) -> Column:
    """Sum of the smaller by sum of the larger numbers of occurrences."""

    def times(array: str, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    common = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))
    )
    return common / (F.size(a) + F.size(b) - common)


def items_of(benchmark: DataFrame) -> DataFrame:
    """Distinct items with their fingerprints and a key."""
    rows = shingled(benchmark, "item_id").filter(F.col("m") >= NGRAM).distinct()
    return rows.select(
        F.xxhash64("item_id", "shingles").alias("item"), "item_id", "m", F.col("shingles").alias("item_shingles"),
        fingerprint("shingles").alias("item_bits"),
    )


def slack(m: Column, threshold: float) -> Column:
    """By how many words an anchor may stand off its place in a window of the threshold.

    Standing early by d, it leaves d of the item's shingles no room before it; late by d, it has d others before it, for
    which as many of the item are left out at the end. At most a share 1 - t of the item's shingles may be left out.
    """
    return F.floor((m - NGRAM + 1) * (1 - threshold) + 1e-9).cast("int")


def anchors_of(items: DataFrame, threshold: float, moved: bool = True) -> DataFrame:
    """Distinct (shingle, m, place) by which windows are laid: a shingle's places in the item, `moved` by up to the slack."""
    ordered = F.array_sort(F.array_distinct("item_shingles"))
    # a share 1 - threshold of all shingles, repeated ones included, may be missing
    needed = F.floor(F.size("item_shingles") * (1 - threshold) + 1e-9).cast("int") + 1
    picked = items.select("m", F.slice(ordered, F.lit(1), needed).alias("picked"), F.posexplode("item_shingles").alias("at", "shingle"))
    picked = picked.filter(F.array_contains("picked", F.col("shingle")))
    off = slack(F.col("m"), threshold) if moved else F.lit(0)
    near = F.sequence(F.col("at") - off, F.col("at") + off)
    return picked.select("shingle", "m", F.explode(near).alias("place")).distinct()


def window(shingles: str, m: Column, start: Column) -> Column:
    """The shingles of m words from `start` on, as far as they lie in the text."""
    first = F.greatest(start, F.lit(0))
    last = F.least(start + m - NGRAM + 1, F.size(shingles))
    return F.slice(shingles, first + 1, F.greatest(last - first, F.lit(0)))


def small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """With a hint to broadcast where the counted rows are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def windows_of(docs: DataFrame, anchors: DataFrame, broadcast_rows: int) -> DataFrame:
    """Distinct (doc_id, m, start, window).

    The anchors are looked for in single shingles first; only texts that hold one are then read again for their windows.
    """
    own = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("hash"), "text")
    # the outer forms keep the optimizer from computing the arrays once more in a filter on their size
    places = shingled(own, "doc_id", "hash").select("doc_id", "hash", F.posexplode_outer("shingles").alias("pos", "shingle"))
    hits = places.join(small(anchors, anchors.count(), broadcast_rows), "shingle")
    starts = hits.select("doc_id", "hash", "m", (F.col("pos") - F.col("place")).alias("start")).distinct()
    # no more starts than the text has anchors
    found = checkpointed(
        starts.groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("t")).agg(F.collect_list(F.struct("m", "start")).alias("at"))
    )
    total = found.agg(F.sum(F.size("at"))).first()[0] or 0
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("t"))
    again = shingled(own.join(small(found, total, broadcast_rows), same), "doc_id", "at")
    cut = F.transform(
        "at", lambda x: F.struct(x["m"].alias("m"), x["start"].alias("start"), window("shingles", x["m"], x["start"]).alias("window"))
    )
    return again.select("doc_id", F.explode_outer(cut).alias("x")).select("doc_id", "x.*").distinct()


def short_leaks(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int) -> DataFrame | None:
    """The rows of `leaks` for the items of one to four words; None if there are no such items."""
    words = hashed(benchmark, "item_id").withColumn("m", F.size("h")).filter((F.col("m") > 0) & (F.col("m") < NGRAM))
    # four numbers at most
    lengths = {r["m"]: r["n"] for r in words.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not lengths:
        return None

    def whole(n: int) -> Column:
        return F.when(F.col("m") == n, F.get(grams(n), F.lit(0)))

    items = words.select("item_id", "m", F.coalesce(*map(whole, sorted(lengths))).alias("gram")).distinct()

    def of_length(n: int) -> Column:
        found = F.transform(grams(n), lambda g, i: F.struct(F.lit(n).alias("m"), i.alias("start_word"), g.alias("gram")))
        return F.coalesce(found, F.array().cast("array<struct<m:int,start_word:int,gram:bigint>>"))

    parts = hashed(docs, "doc_id").select("doc_id", F.explode(F.concat(*map(of_length, sorted(lengths)))).alias("x"))
    met = parts.select("doc_id", "x.*").join(small(items, sum(lengths.values()), broadcast_rows), ["m", "gram"])
    return met.groupBy("doc_id", "item_id", "m").agg(F.min("start_word").alias("start_word")).select(
        "doc_id", "item_id", F.lit(1.0).alias("similarity"), "start_word", F.col("m").alias("n_words"), F.lit(0).alias("distance"),
    )


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, broadcast_rows: int = BROADCAST_ROWS, moved: bool = True
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words, distance): the best window of each pair."""
    items = checkpointed(items_of(benchmark))
    windows = windows_of(docs, anchors_of(items, threshold, moved), broadcast_rows)
    marked = windows.select("doc_id", "m", "start", "window", fingerprint("window").alias("bits"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    marked = marked.select("*", numbers).withColumn("value", block("bits", F.col("block")))
    near = [0, *(1 << b for b in range(BLOCK_BITS))]
    listed = items.select("item", "item_id", "m", "item_bits", numbers).select(
        "item", "m", "item_bits", "block", F.explode(F.array(*[F.lit(x).cast("long") for x in near])).alias("change")
    ).withColumn("value", block("item_bits", F.col("block")).bitwiseXOR(F.col("change"))).drop("change")
    n_items = items.count()
    listed = small(listed, n_items * BLOCKS * len(near), broadcast_rows)
    differ = F.col("bits").bitwiseXOR(F.col("item_bits"))
    # the block of this row is the first by which the two meet
    first = F.array_position(
        F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), lambda b: F.bit_count(block(differ, b)) <= 1), F.lit(True)
    ) == F.col("block") + 1
    near_pairs = (
        marked.join(listed, ["m", "block", "value"])
        .withColumn("distance", F.bit_count(differ))
        .filter((F.col("distance") <= RADIUS) & first)
        .select("doc_id", "start", "window", "item", "distance")
    )
    # about 8 bytes per word of an item
    words = items.agg(F.sum(F.col("m").cast("long"))).first()[0] or 0
    full = small(items.select("item", "item_id", "m", "item_shingles"), words, broadcast_rows)
    verified = near_pairs.join(full, "item").withColumn("similarity", weighted_similarity("window", "item_shingles"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "m", "distance")).alias("best")
    short = short_leaks(docs, benchmark, broadcast_rows)
    found = verified.filter(F.col("similarity") >= threshold).select("doc_id", "item_id", "similarity", "start", "m", "distance")
    if short is not None:
        found = found.union(short)
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start_word"),
        F.col("best.m").alias("n_words"), F.col("best.distance").alias("distance"),
    )
