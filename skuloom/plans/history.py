"""All-time sales kept up to date day by day.

The store holds, for every export day, the sums of its lines per SKC in a form that adds up further without rounding (whole-number
words). A day is one partition: merging it in again replaces it, days may come in any order, and the report adds all days.
So a new export costs a pass over itself and over the sums, never over the history of lines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.operators.aggregates import BANDS_OF, all_present, final_sums, partial_sums
from skuloom.plans.sales import SALES_KEYS, SALES_SUMS, sold_lines

DAY = "export_day"


def merge_day(lines: DataFrame, store: str, day: dt.date) -> None:
    """Put the lines of a day's export into the store, in place of what it held for that day.

    The day's folder is written apart and takes its place when it is whole. An export without lines empties the day.
    """
    keyed = sold_lines(lines).filter(all_present(SALES_KEYS))
    sums = partial_sums(keyed, SALES_KEYS, SALES_SUMS, any_size=True)
    flat = sums.select("*", *[F.col(BANDS_OF)[m].alias(f"_band_{m}") for m in SALES_SUMS]).drop(BANDS_OF)
    flat.write.mode("overwrite").parquet(f"{store.rstrip('/')}/{DAY}={day.isoformat()}")


def all_time_sales(spark: SparkSession, store: str) -> DataFrame:
    """The report over all days of the store, equal to that over all their lines."""
    flat = spark.read.parquet(store)
    bands = [F.col(f"_band_{m}") for m in SALES_SUMS]
    apart = F.coalesce(*bands).isNotNull()
    sums = flat.withColumn(BANDS_OF, F.when(apart, F.struct(*[b.alias(m) for b, m in zip(bands, SALES_SUMS, strict=True)])))
    return final_sums(sums, SALES_KEYS, SALES_SUMS)
