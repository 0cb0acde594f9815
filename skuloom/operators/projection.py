"""Projections and filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.functions.dates import parse_ts

ORDER = "_ord"


def conform(df: DataFrame, columns: T.StructType | Sequence[str]) -> DataFrame:
    """Project to a column list: reorder, prune, add missing columns as null.

    With a StructType, present columns are cast to its types as well; a field marked as lenient reads null where its text
    says something else. The ingest order keeps the type it was stamped with.
    """
    if isinstance(columns, T.StructType):

        def field(f: T.StructField) -> Column:
            if f.name not in df.columns:
                return F.lit(None).cast(f.dataType)
            c = F.col(f.name)
            kind = df.schema[f.name].dataType
            # a column that has its type stays plain, so that filters on it reach the scan
            if f.name == ORDER or kind == f.dataType:
                return c
            if isinstance(f.dataType, T.TimestampNTZType) and isinstance(kind, T.StringType):
                return parse_ts(c, strict=not f.metadata.get("lenient"))
            return c.try_cast(f.dataType) if f.metadata.get("lenient") else c.cast(f.dataType)

        return df.select(*[field(f).alias(f.name) for f in columns])
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
    )


def drop_columns(df: DataFrame, *names: str, positions: Iterable[int] = ()) -> DataFrame:
    """Drop columns by name and by position."""
    return df.drop(*names, *[df.columns[i] for i in positions])


def fill(df: DataFrame, columns: Sequence[str], value: float | str = 0) -> DataFrame:
    """Replace null by a constant in the given columns."""
    return df.fillna({c: value for c in columns})


def differs(c: Column | str, value: object) -> Column:
    """Not equal, where null differs from every value."""
    c = F.col(c) if isinstance(c, str) else c
    return ~c.eqNullSafe(F.lit(value))


def any_nonzero(columns: Sequence[str]) -> Column:
    """True where at least one of the columns is not 0."""
    return reduce(or_, [F.col(c) != 0 for c in columns])


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by name, columns missing on one side read null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_where(df: DataFrame, *conditions: Column, order: str | None = None) -> DataFrame:
    """Distinct rows that meet at least one condition.

    `order` names an ingest position: it does not make rows differ, and each
    distinct row keeps its first position.
    """
    kept = df.filter(reduce(or_, conditions))
    if order is None:
        return kept.distinct()
    keys = [c for c in df.columns if c != order]
    return kept.groupBy(*keys).agg(F.min(order).alias(order)).select(*df.columns)
