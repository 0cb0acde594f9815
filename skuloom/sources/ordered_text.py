"""The place of a row in its text file, the same however the file is cut into splits.

A text source tells a row's file and the byte at which its split starts, but no place in the file. Rows are counted per split
in one pass that reads no column; the counts before a split, a row per split, are what its rows add to their place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDER = "_ord"
FILE, START, ID = "_file", "_start", "_id"


def text_rows(df: DataFrame) -> DataFrame:
    """The rows of a text source, just read, with `_ord`: file, then place in the file from 0 on.

    A split is read from its start by one task, so a row's number within the scan less the first of its split is its
    place in the split. Both passes list the same files with the same settings and so cut them alike; a filter stays above
    the numbers, so that it changes neither.
    """
    placed = df.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(START),
        F.monotonically_increasing_id().alias(ID),
    )
    splits = placed.groupBy(FILE, START).agg(F.min(ID).alias("_first"), F.count(F.lit(1)).alias("_n"))
    # a row per split, each file by itself
    earlier = Window.partitionBy(FILE).orderBy(START).rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select(FILE, START, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_add"))
    order = F.struct(F.col(FILE).alias("file"), (F.col(ID) + F.col("_add")).alias("row")).alias(ORDER)
    return placed.join(before, [FILE, START]).select(*(F.col(f"`{c}`") for c in df.columns), order)


def land(spark: SparkSession, path: str, target: str, **options) -> str:
    """Write a CSV export as parquet with `_ord`, and return where.

    `read_table` reads it like the export itself, in the same order, and its filters reach the scan. Cells stay text, and
    only the empty text is missing.
    """
    raw = spark.read.csv(path, **{"header": True, **options})
    cells = [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns]
    text_rows(raw).select(*cells, ORDER).write.mode("overwrite").parquet(target)
    return target
