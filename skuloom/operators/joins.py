"""Lookup joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.operators.windows import keep_one

# A key with more rows than this is split into parts of about this size, where salting is asked for.
SALT_ROWS = 1_000_000

# Keys that a sketch of frequent keys holds: a power of two, and its share that may be full.
SKETCH_KEYS = 1 << 16
SKETCH_FILL = 0.75
# Sketches are joined in so many groups first.
SKETCH_GROUPS = 512

# A join that multiplies rows is dealt into so many tasks a core, where its keys are texts.
PRODUCT_TASKS = 8

ORDER = "_ord"


def _equal(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs])


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    take: Mapping[str, str] | Sequence[str],
    null_safe: bool = True,
    dedupe: Sequence[Column | str] | None = None,
    salt_rows: int | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left join that adds columns of a lookup table.

    A null key finds a null key unless `null_safe` is off, and a key found several times multiplies the row unless
    `dedupe` gives the order by which the first row per key is taken. `on` maps columns of `df` to columns of `dim`,
    `take` maps columns of `dim` to the names they get.

    Spark chooses the join and splits uneven partitions of a shuffle while it runs. Where a key may hold more rows than
    a task should read, `salt_rows` splits it beforehand: see `split_join`, also for `spread_by`.
    """
    on = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    take = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    clash = set(take.values()) & set(df.columns)
    if clash:
        raise ValueError(f"columns already there: {sorted(clash)}")
    if dedupe is not None:
        dim = keep_one(dim, list(on.values()), dedupe)
    pairs = [(left, f"_key{i}") for i, left in enumerate(on)]
    side = dim.select(
        *[F.col(right).alias(key) for (_, key), right in zip(pairs, on.values())],
        *[F.col(src).alias(name) for src, name in take.items()],
    )
    if salt_rows is None:
        joined = df.join(side, _equal(pairs, null_safe), "left")
    else:
        joined = split_join(df, side, pairs, salt_rows, spread_by=spread_by, null_safe=null_safe)
    return joined.select(*df.columns, *take.values())


def chained_lookup(
    df: DataFrame,
    first: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    second: DataFrame,
    second_on: Mapping[str, str],
    second_take: Mapping[str, str] | Sequence[str],
    salt_rows: int | None = None,
    derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A lookup in `first`, then one in `second` by columns that the first has added; the rows of two lookups in a row.

    The rows of `first` take theirs from `second` before they are joined, so that where both multiply the rows of `df`, the
    many rows are the result of one join and no shuffle carries them. `derive` adds columns told from those that the lookups
    have added, before rows are multiplied as well.
    """
    derive = dict(derive or {})
    second_take = dict(second_take) if isinstance(second_take, Mapping) else {c: c for c in second_take}
    side = first.select(
        *[F.col(right).alias(f"_on{i}") for i, right in enumerate(on.values())], *[F.col(src).alias(name) for src, name in take.items()]
    )
    side = lookup(side, second, second_on, second_take, salt_rows=salt_rows).withColumns(derive)
    pairs = [(left, f"_on{i}") for i, left in enumerate(on)]
    added = [*take.values(), *second_take.values(), *derive]
    found = product_join(df, side, pairs).select(*df.columns, *added)
    # a row that finds nothing in the first has a null key for the second; as columns of the join, not as constants, which
    # would leave no key to join by
    known = side.groupBy(*[key for _, key in pairs]).agg(F.first(F.lit(True)).alias("_found"), *[F.any_value(name).alias(name) for name in take.values()])
    none = df.join(known, _equal(pairs, True), "left").filter("_found IS NULL").select(*df.columns, *take.values())
    none = lookup(none, second, second_on, second_take, salt_rows=salt_rows).withColumns(derive)
    return found.unionByName(none.select(*df.columns, *added))


def product_join(df: DataFrame, side: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join in which many rows of both sides may share a key; a null finds a null.

    The rows that a task makes are the product of those it reads. Spark sizes its tasks by what they read and would make a few
    large ones, so both sides are dealt by key into a number of tasks that it keeps: `PRODUCT_TASKS` for each core.
    """
    texts = all(isinstance(x.schema[c].dataType, T.StringType) for pair in pairs for x, c in zip((df, side), pair))
    if not texts:
        return df.join(side, _equal(pairs, True))
    tasks = PRODUCT_TASKS * df.sparkSession.sparkContext.defaultParallelism

    def dealt(x: DataFrame, mark: str, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
        # what a null-safe join compares, as columns, so that the join finds its rows dealt
        told = {f"{mark}{i}{n}": c for i, k in enumerate(keys) for n, c in enumerate((F.coalesce(k, F.lit("")), F.isnull(k)))}
        return x.withColumns(told).repartition(tasks, *told), list(told)

    left, left_keys = dealt(df, "_left", [a for a, _ in pairs])
    right, right_keys = dealt(side, "_right", [b for _, b in pairs])
    return left.join(right, _equal(list(zip(left_keys, right_keys)), False)).select(*df.columns, *side.columns)


def split_join(
    df: DataFrame,
    side: DataFrame,
    pairs: Sequence[tuple[str, str]],
    split_rows: int = SALT_ROWS,
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Left join in which frequent keys of the left side are split.

    A sketch (`frequent_keys`) finds the keys with more than `split_rows` rows in one pass over the key columns, when this
    function is called. Each is cut into parts by a hash of the row (of its columns `spread_by`, by default its ingest
    order); the matching rows of `side` are repeated for every part. The part is a function of the row, so a task that
    runs again puts each row where it was before.

    The counts only steer the work, any row finds its partners whatever they
    say. So they can be taken from an earlier stage of `df`, given as
    `keys_from`, where the key columns have the same names.
    """
    left_keys = [left for left, _ in pairs]
    hot_names = [f"_hot{i}" for i in range(len(pairs))]
    source = df if keys_from is None else keys_from
    found = frequent_keys(source.select(*[F.col(c).alias(h) for c, h in zip(left_keys, hot_names)]), split_rows)
    # at most SKETCH_KEYS rows
    hot = F.broadcast(found.select(*hot_names, F.ceil(F.col("rows") / split_rows).cast("int").alias("_parts")))
    row_hash = F.xxhash64(*(spread_by or ([ORDER] if ORDER in df.columns else df.columns)))
    left = df.join(hot, _equal(list(zip(left_keys, hot_names)), True), "left").select(
        *df.columns,
        F.when(F.col("_parts").isNull(), F.lit(0))
        .otherwise(F.pmod(row_hash, F.col("_parts")))
        .cast("int")
        .alias("_part"),
    )
    right = side.join(
        hot, _equal([(key, h) for (_, key), h in zip(pairs, hot_names)], True), "left"
    ).select(
        *side.columns,
        F.explode(
            F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))
        ).alias("_part_of"),
    )
    return left.join(
        right, _equal(pairs, null_safe) & (F.col("_part") == F.col("_part_of")), "left"
    ).select(*df.columns, *side.columns)


def frequent_keys(keys: DataFrame, over: int, sketch_keys: int = SKETCH_KEYS) -> DataFrame:
    """The keys (rows of `keys`, of any columns) that stand in more than `over` rows, and about how many: `rows`.

    One pass and no shuffle but of sketches, each of `sketch_keys` keys at most. Of n rows, counts are off by 3.5 * n /
    `sketch_keys` at most, and every key with more than `over` and 7 * n / `sketch_keys` rows is found, whatever the order of
    the rows. A key in fewer rows may be found too. The result is a small local table, at most `sketch_keys` rows, so that all
    who join it see the same keys and counts also where tasks run again.
    """
    held = int(sketch_keys * SKETCH_FILL)
    # a key as one text, which keeps nulls apart from all values
    item = F.to_json(F.struct(*[F.col(f"`{c}`") for c in keys.columns])).alias("item")
    sketches = (
        keys.select(item, (F.spark_partition_id() % SKETCH_GROUPS).alias("part"))
        .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(item, {held})").alias("sketch"))
    )
    # no rows have no sketch
    whole = sketches.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {held})").alias("sketch"))
    top = whole.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {held})")).alias("x")).select("x.item", F.col("x.count").alias("rows"))
    rows = top.filter(F.col("rows") > over).collect()
    found = keys.sparkSession.createDataFrame(rows, "item string, rows long")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in keys.schema])
    found = found.select(F.from_json("item", schema).alias("key"), "rows").select("key.*", "rows")
    if any(isinstance(f.dataType, (T.FloatType, T.DoubleType)) for f in schema):
        # 0.0 and -0.0 are one key, but two texts
        found = found.groupBy(*keys.columns).agg(F.sum("rows").alias("rows"))
    return found


def keep_matching(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in `keys`; a null key matches a null key."""
    pairs = [(left, f"_key{i}") for i, left in enumerate(on)]
    side = keys.select(*[F.col(r).alias(k) for (_, k), r in zip(pairs, on.values())])
    return df.join(side, _equal(pairs, True), "left_semi")
