"""Window operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from skuloom.functions.numeric import WORDS, band, finite, joined, shifted, split_columns
from skuloom.operators.blocks import in_tasks, tasks_for

#: A key's rows go to so many tasks, where rows are dealt before the first of a key is taken.
KEY_PARTS = 16


def window_sums(df: DataFrame, window: WindowSpec, measures: Mapping[str, str]) -> DataFrame:
    """Sums over a window under new names; 0 where there is nothing to add, independent of the order of equal rows.

    The words of a measure are computed once per row, not once per window function.
    """
    own = df.withColumns({f"_x_{name}": finite(src) for src, name in measures.items()})
    split, words = split_columns(own, [f"_x_{name}" for name in measures.values()])
    flat = {f"_w{i}_{name}": w for name in measures.values() for i, w in enumerate(words[f"_x_{name}"])}
    summed = split.withColumns(flat).withColumns({f"_s{c}": F.sum(c).over(window) for c in flat})
    sums = {name: joined([F.col(f"_s_w{i}_{name}") for i in range(WORDS)]) for name in measures.values()}
    kept = [c for c in df.columns if c not in sums]
    return summed.select(*kept, *[c.alias(name) for name, c in sums.items()])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Mapping[str, str], any_size: bool = False
) -> DataFrame:
    """Running sums per key. Meant for aggregated rows, a few per key and day; `prefix_sums` takes keys of any size.

    With `any_size`, doubles of the whole range add up: a key's numbers are scaled by its highest exponent band, and what is
    smaller than the largest number of the key by 2^66 and more does not count.
    """
    whole = Window.partitionBy(*keys)
    w = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if not any_size:
        return window_sums(df, w, measures)
    scaled = df.withColumns({f"_band_{name}": F.max(band(finite(src))).over(whole) for src, name in measures.items()})
    small = {f"_small_{name}": shifted(finite(src), F.col(f"_band_{name}")) for src, name in measures.items()}
    summed = window_sums(scaled.withColumns(small), w, {f"_small_{name}": f"_sum_{name}" for name in measures.values()})
    back = {name: shifted(F.col(f"_sum_{name}"), F.col(f"_band_{name}"), up=True) for name in measures.values()}
    kept = [c for c in df.columns if c not in back]
    return summed.select(*kept, *[c.alias(name) for name, c in back.items()])


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], rows: int | None = None) -> DataFrame:
    """First row per key by the given order; a null key is a key.

    Spark cuts each group to one row before the shuffle (WindowGroupLimit), so a
    frequent key costs no more than one row per task. For that a task sorts its rows: given `rows`, about how many there
    are, they are dealt into tasks of bounded size first, a key's rows into up to `KEY_PARTS`; the order is names then.
    """
    if rows is not None:
        df = in_tasks(df, tasks_for(rows), *keys, F.pmod(F.xxhash64(*order), F.lit(KEY_PARTS)))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def top_k(df: DataFrame, k: int, order: Sequence[Column | str], rank: str | None = None) -> DataFrame:
    """The k first rows by the given order, with their rank."""
    top = df.orderBy(*order).limit(k)
    if rank is None:
        return top
    # the window sees at most k rows
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def flag_top(
    df: DataFrame, k: int, order: Sequence[Column | str], key: str, name: str, yes: str, no: str
) -> DataFrame:
    """Label whether a row is among the k first; `key` identifies the row."""
    top = df.orderBy(*order).limit(k).select(F.col(key).alias("_top"))
    # at most k rows
    return (
        df.join(F.broadcast(top), F.col(key) == F.col("_top"), "left")
        .withColumn(name, F.when(F.col("_top").isNotNull(), F.lit(yes)).otherwise(F.lit(no)))
        .drop("_top")
    )


def label_rank(c: Column | str, labels: Sequence[str]) -> Column:
    """Position of a label in a fixed list, unknown labels behind all of them."""
    c = F.col(c) if isinstance(c, str) else c
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), c)
    return F.when(position > 0, position.cast("int")).otherwise(F.lit(len(labels) + 1))
