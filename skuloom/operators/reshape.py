"""Long to wide and back.

Every wide table comes in two forms. The map form has one column from the value of `by` to its cell; it needs no list, no
extra job, and has any number of cells. The column form takes the list of values and has one column for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.functions.numeric import joined, words
from skuloom.operators.aggregates import all_present
from skuloom.operators.blocks import row_positions
from skuloom.operators.joins import lookup


def _cells(key: Column | str, value: Column | str) -> Column:
    """Aggregate: map of the rows of a group. A key occurs once in it, as it has been grouped by."""
    pair = F.struct((F.col(key) if isinstance(key, str) else key).alias("k"), (F.col(value) if isinstance(value, str) else value).alias("v"))
    return F.map_from_entries(F.array_sort(F.collect_list(pair)))


def _in_row(wide: DataFrame, cells: str, keys: Sequence[Column]) -> DataFrame:
    """The cells of the given keys as an array `_row`, null where there is none; columns then only pick from it."""
    return wide.withColumn("_row", F.transform(F.array(*keys), lambda k: F.try_element_at(F.col(cells), k)))


def spread_sum_map(df: DataFrame, keys: Sequence[str], by: str, measure: str, total: str, cells: str) -> DataFrame:
    """The sum of a measure per value of `by` as a map, and over all values."""
    names = [f"_w{i}" for i in range(len(words(measure)))]
    sums = (
        df.filter(all_present([*keys, by])).groupBy(*keys, by)
        .agg(*[F.sum(w).alias(n) for w, n in zip(words(measure), names, strict=True)])
    )
    return sums.groupBy(*keys).agg(
        joined([F.sum(n) for n in names]).alias(total), _cells(by, joined(names)).alias(cells)
    )


def spread_sum(
    df: DataFrame, keys: Sequence[str], by: str, values: Sequence, measure: str, total: str
) -> DataFrame:
    """One column per listed value of `by` with the sum of a measure, 0 where empty; `total` is over the listed values."""
    wide = spread_sum_map(df.filter(F.col(by).isin(*values)), keys, by, measure, total, "_cells")
    wide = _in_row(wide, "_cells", [F.lit(v) for v in values])
    return wide.select(*keys, total, *[F.coalesce(F.get("_row", i), F.lit(0.0)).alias(str(v)) for i, v in enumerate(values)])


def spread_flag_map(df: DataFrame, keys: Sequence[str], by: Sequence[str], flag: str, cells: str) -> DataFrame:
    """The largest flag per combination of `by`, as a map from a struct of them."""
    flags = df.filter(all_present([*keys, *by])).groupBy(*keys, *by).agg(F.max(flag).alias("_flag"))
    return flags.groupBy(*keys).agg(_cells(F.struct(*by), "_flag").alias(cells))


def spread_flag(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    values: Sequence[tuple[str, ...]],
    flag: str,
    yes: str,
    no: str = "",
) -> DataFrame:
    """One column per listed combination of `by` that says whether any row is flagged.

    A column is named by its labels, joined by "_"; where two would have one name, "_" inside labels is doubled.
    """
    names = ["_".join(v) for v in values]
    if len(set(names)) < len(names):
        names = ["_".join(x.replace("_", "__") for x in v) for v in values]

    def holds(combination: tuple[str, ...]) -> Column:
        return reduce(and_, [F.col(b) == F.lit(x) for b, x in zip(by, combination, strict=True)])

    # a key whose cells are all outside the list keeps its row, so rows are not filtered but by their keys
    flags = df.filter(all_present([*keys, *by])).groupBy(*keys, *by).agg(F.max(flag).alias("_flag"))
    cells = [F.max(F.when(holds(v), F.col("_flag"))).alias(f"_cell{i}") for i, v in enumerate(values)]
    wide = flags.groupBy(*keys).agg(*cells)
    return wide.select(
        *keys, *[F.when(F.col(f"_cell{i}") == 1, F.lit(yes)).otherwise(F.lit(no)).alias(n) for i, n in enumerate(names)]
    )


def spread_metrics_map(df: DataFrame, keys: Sequence[str], by: str, metrics: Sequence[str], cells: str) -> DataFrame:
    """The metrics per value of `by`, as a map to a struct; (keys, by) identifies a row."""
    return df.filter(F.col(by).isNotNull()).groupBy(*keys).agg(_cells(by, F.struct(*metrics)).alias(cells))


def spread_metrics(
    df: DataFrame, keys: Sequence[str], by: str, values: Sequence, metrics: Sequence[str]
) -> DataFrame:
    """One column per metric and listed value of `by`, named metric_value."""
    wide = spread_metrics_map(df, keys, by, metrics, "_cells")
    wide = _in_row(wide, "_cells", [F.lit(v) for v in values])
    return wide.select(
        *keys, *[F.get("_row", i).getField(m).alias(f"{m}_{v}") for m in metrics for i, v in enumerate(values)]
    )


def metrics_to_rows_map(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], by: str, cells: str, name: str = "metric"
) -> DataFrame:
    """One row per key and metric with a map of its values; a metric without any value gives no row."""
    long = (
        df.select(*keys, by, *metrics)
        .unpivot([*keys, by], list(metrics), name, "_value")
        .filter(F.col("_value").isNotNull() & F.col(by).isNotNull())
    )
    return long.groupBy(*keys, name).agg(_cells(by, "_value").alias(cells))


def metrics_to_rows(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    by: str,
    values: Sequence,
    name: str = "metric",
) -> DataFrame:
    """One row per key and metric, one column per listed value of `by`.

    A metric without any of these values for a key gives no row.
    """
    wide = metrics_to_rows_map(df.filter(F.col(by).isin(*values)), keys, metrics, by, "_cells", name)
    wide = _in_row(wide, "_cells", [F.lit(v) for v in values])
    return wide.select(*keys, name, *[F.get("_row", i).alias(str(v)) for i, v in enumerate(values)])


def column_blocks(
    df: DataFrame, keys: Sequence[str], by: str, metrics: Sequence[str], width: int = 256
) -> tuple[DataFrame, DataFrame]:
    """(blocks, columns): a wide table of any number of columns, cut into blocks of `width` of them.

    `columns` has a row per value of `by` with its `block` and its place `nth` in the block, by value. `blocks` has a row per
    key and block in which the key has a cell: `cells` is an array of `width` structs of the metrics, in the order of the
    columns, null where there is none. So neither a row nor a map grows with the number of columns. (keys, by) identifies a
    row; rows without a value of `by` are left out.
    """
    kept = df.filter(F.col(by).isNotNull())
    places = row_positions(kept.select(by).distinct(), [by], "_position", block_rows=1_000_000)
    columns = places.select(
        by, F.floor((F.col("_position") - 1) / width).cast("int").alias("block"), ((F.col("_position") - 1) % width).cast("int").alias("nth")
    )
    placed = lookup(kept.select(*keys, by, *metrics), columns, [by], {"block": "_block", "nth": "_nth"}, null_safe=False)
    cell = F.struct(F.col("_nth").alias("k"), F.struct(*metrics).alias("v"))
    found = placed.groupBy(*keys, F.col("_block").alias("block")).agg(F.map_from_entries(F.collect_list(cell)).alias("_cells"))
    row = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.try_element_at("_cells", i))
    return found.select(*keys, "block", row.alias("cells")), columns


def from_blocks(blocks: DataFrame, columns: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The long form back: a row per key and value of `by` that has a cell."""
    cells = blocks.select(*keys, F.col("block").alias("_block"), F.posexplode("cells").alias("_nth", "_cell")).filter("_cell IS NOT NULL")
    named = cells.join(columns, (F.col("_block") == F.col("block")) & (F.col("_nth") == F.col("nth")))
    return named.select(*keys, by, "_cell.*")
