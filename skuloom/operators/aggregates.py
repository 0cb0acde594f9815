"""Aggregations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.functions.numeric import (
    WORDS, band, finite, joined, ratio, round_even, shifted, split_columns, total,
)

#: Exponent bands of a partial sum, by measure; null where all are ordinary.
BANDS_OF = "_bands"


def all_present(columns: Sequence[str]) -> Column:
    """True where none of the columns is null; reaches the scan, unlike dropna."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def group_sum(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] | Mapping[str, str],
    keep_null_keys: bool = False,
    any_size: bool = False,
) -> DataFrame:
    """Sums per key; rows with a null key are left out, an empty sum is 0.

    Numbers from 4.6e18 on raise, and parts under 2^-66 are left out, unless `any_size`: then doubles of the whole range add
    up, by exponent band, for one more shuffle of the sums.
    """
    if not isinstance(measures, Mapping):
        measures = {m: m for m in measures}
    if not keep_null_keys and keys:
        df = df.filter(all_present(keys))
    names = list(measures.values())
    parts = partial_sums(df, keys, measures, any_size)
    if any_size:
        return final_sums(parts, keys, names, keep_null_keys=True)
    return parts.select(*keys, *[joined([F.col(f"_{m}_{i}") for i in range(WORDS)]).alias(m) for m in names])


def partial_sums(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str], any_size: bool = False
) -> DataFrame:
    """Sums per key, null keys included, that `final_sums` can add further without rounding in between.

    With `any_size`, a row that holds a number out of the ordinary is added apart, with rows of the same exponent bands;
    there are as many rows per key as there are combinations of bands, one where all is ordinary.
    """
    if not isinstance(measures, Mapping):
        measures = {m: m for m in measures}
    names = list(measures.values())
    # every measure is computed once; what follows refers to the column
    rows = df.select(*keys, *[finite(src).alias(f"_x_{m}") for src, m in measures.items()])
    by = list(keys)
    if any_size:
        bands = [band(F.col(f"_x_{m}")) for m in names]
        apart = reduce(or_, [F.coalesce(b != 0, F.lit(False)) for b in bands])
        own = F.struct(*[b.alias(m) for m, b in zip(names, bands, strict=True)])
        rows = rows.withColumn(BANDS_OF, F.when(apart, own))
        rows = rows.withColumns({f"_x_{m}": shifted(F.col(f"_x_{m}"), F.col(BANDS_OF)[m]) for m in names})
        by.append(BANDS_OF)
    rows, split = split_columns(rows, [f"_x_{m}" for m in names])
    sums = [F.sum(w).alias(f"_{m}_{i}") for m in names for i, w in enumerate(split[f"_x_{m}"])]
    return rows.groupBy(*by).agg(*sums)


def _field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def _of_bands(sums: Column) -> Column:
    """The double of summed words in several bands, (band, words) each: exact in a band, then joined largest first."""
    bands = F.sort_array(F.array_distinct(F.transform(sums, lambda x: x["band"])), asc=False)

    nothing = F.lit(0).cast("long")

    def value(b: Column) -> Column:
        own = F.filter(sums, lambda x: x["band"] == b)
        of_word = [F.transform(own, _field(f"w{i}")) for i in range(WORDS)]
        added = [F.aggregate(w, nothing, lambda total, x: total + F.coalesce(x, nothing)) for w in of_word]
        return shifted(joined(added), b, up=True)

    return F.aggregate(F.transform(bands, value), F.lit(0.0), lambda total, x: total + x)


def final_sums(df: DataFrame, keys: Sequence[str], measures: Sequence[str], keep_null_keys: bool = False) -> DataFrame:
    """Sums per key of partial sums; rows with a null key are left out unless asked for."""
    if not keep_null_keys:
        df = df.filter(all_present(keys))

    def word(m: str, i: int) -> Column:
        return F.col(f"_{m}_{i}")

    if BANDS_OF not in df.columns:
        sums = [F.sum(word(m, i)).alias(f"_{m}_{i}") for m in measures for i in range(WORDS)]
        out = df.groupBy(*keys).agg(*sums)
        return out.select(*keys, *[joined([word(m, i) for i in range(WORDS)]).alias(m) for m in measures])

    def apart(m: str) -> Column:
        return F.coalesce(F.col(BANDS_OF)[m] != 0, F.lit(False))

    def ordinary(m: str) -> list[Column]:
        return [F.sum(F.when(~apart(m), word(m, i))).alias(f"_{m}_{i}") for i in range(WORDS)]

    def others(m: str) -> Column:
        """A row per combination of bands that partial sums have."""
        entry = F.struct(F.col(BANDS_OF)[m].alias("band"), *[word(m, i).alias(f"w{i}") for i in range(WORDS)])
        return F.collect_list(F.when(apart(m), entry)).alias(f"_{m}_others")

    def value(m: str) -> Column:
        plain = F.struct(F.lit(0).alias("band"), *[word(m, i).alias(f"w{i}") for i in range(WORDS)])
        every = F.concat(F.col(f"_{m}_others"), F.array(plain))
        return F.when(F.size(f"_{m}_others") == 0, joined([word(m, i) for i in range(WORDS)])).otherwise(_of_bands(every))

    sums = df.groupBy(*keys).agg(*[c for m in measures for c in (*ordinary(m), others(m))])
    return sums.select(*keys, *[value(m).alias(m) for m in measures])


def first_nonnull(
    df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str], name: str | None = None
) -> DataFrame:
    """First value that is not null per key, by the given order."""
    position = F.struct(*[F.col(c) for c in order], F.col(column))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(column, position).alias(name or column))
    )


def weighted_mean(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, mean: str, weights: str
) -> DataFrame:
    """Weighted mean per key, rounded to two digits at every step."""
    product = round_even(F.col(weight) * F.col(value), 2)
    return (
        df.groupBy(*keys)
        .agg(total(product).alias("_products"), total(weight).alias(weights))
        .withColumn("_products", round_even("_products", 2))
        .withColumn(mean, ratio("_products", weights, 2))
        .drop("_products")
    )


def first_day_above(
    daily: DataFrame, key: str, day: str, measure: str, threshold: float, name: str
) -> DataFrame:
    """Earliest day per key on which the daily sum, as given, exceeds a threshold."""
    return daily.filter(F.col(measure) > threshold).groupBy(key).agg(F.min(day).alias(name))


def dense_grid(
    df: DataFrame,
    key: str,
    bin_column: str,
    bins: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Aggregates per key and bin, with a zero row for every empty bin.

    `measures` maps output names to ("count" | "sum", column). The rows are
    aggregated by key and bin, in part before the shuffle; the bins are a short
    fixed list, so a key's rows, one per bin, then fill an array of all bins.
    A key whose rows are all outside the bins has zero rows too.
    """
    aggregates = {
        name: (F.count(column) if kind == "count" else total(column)).alias(name)
        for name, (kind, column) in measures.items()
    }
    cells = df.filter(F.col(key).isNotNull()).groupBy(key, bin_column).agg(*aggregates.values())
    listed = F.when(F.col(bin_column).isin(*bins), F.struct(bin_column, *measures))
    found = cells.groupBy(key).agg(F.collect_list(listed).alias("_cells"))

    def row(text: str) -> Column:
        own = F.get(F.filter("_cells", lambda c: c[bin_column] == text), F.lit(0))
        kinds = {name: "long" if kind == "count" else "double" for name, (kind, _) in measures.items()}
        values = [F.coalesce(own[m], F.lit(0).cast(kind)).alias(m) for m, kind in kinds.items()]
        return F.struct(F.lit(text).alias(bin_column), *values)

    return found.select(key, F.inline(F.array(*[row(text) for text in bins])))


def with_subtotals(
    df: DataFrame, key: str, part: str, measures: Sequence[str], subtotal: str
) -> DataFrame:
    """Rows per (key, part) and one subtotal row per key."""
    return (
        df.groupingSets([[key, part], [key]], key, part)
        .agg(*[total(m).alias(m) for m in measures], F.grouping(part).alias("_subtotal"))
        .withColumn(part, F.when(F.col("_subtotal") == 1, F.lit(subtotal)).otherwise(F.col(part)))
        .drop("_subtotal")
    )
