"""Positions and running sums over all rows, or over keys of any size, in blocks of bounded size.

Rows are dealt into blocks by range, each block is numbered or summed by itself, and what lies before it is added as an offset.
No task sees more than a block and no window is without a partition. The dealt rows are written to the folder of
spark.checkpoint.dir first: ranges come from a sample that another run of the same plan would draw anew.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuloom.functions.numeric import WORDS, finite, joined, split_columns

BLOCK_ROWS = 1_000_000
# More blocks than this are for rows that need them only: each is a task, a row for the driver and some hundred rows of the
# sample that ranges come from.
MOST_BLOCKS = 512
BLOCK, TIE = "_block", "_tie"
# So many rows that a task sorts or aggregates, where tasks are dealt by `in_tasks`.
TASK_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session may make one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="skuloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The rows as they are now, read back from the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def tasks_for(rows: int, task_rows: int = TASK_ROWS) -> int:
    """How many tasks of about `task_rows` rows."""
    return max(1, -(-rows // task_rows))


def in_tasks(df: DataFrame, tasks: int, *by: Column | str) -> DataFrame:
    """The rows dealt by hash into so many tasks.

    Scans and shuffles give a task a share of all bytes, so that what it sorts or aggregates grows with the table up to 64 or 128
    MB of compressed rows. Tasks dealt by number keep their rows: two sides of a join, dealt alike by their keys, meet without
    another shuffle, and so does a grouping by these columns and more.
    """
    return df.repartition(tasks, *by)


def in_blocks(df: DataFrame, order: Sequence[Column | str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows with `_block`, ascending along the order, and `_tie`, which tells rows apart that the order does not.

    Where there would be more than `MOST_BLOCKS`, blocks hold more than `block_rows` rows, up to `BLOCK_ROWS`.
    """
    rows = df.count()
    fewest = -(-rows // max(block_rows, BLOCK_ROWS))
    blocks = max(1, fewest, min(MOST_BLOCKS, -(-rows // block_rows)))
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    return written(tied.repartitionByRange(blocks, *order, TIE).withColumn(BLOCK, F.spark_partition_id()))


def row_positions(
    df: DataFrame, order: Sequence[Column | str], name: str = "position", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every row with its position from 1 on; rows that the order does not tell apart follow in any order."""
    rows = in_blocks(df, order, block_rows)
    # a row per block
    sizes = sorted((r[BLOCK], r["n"]) for r in rows.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n")).collect())
    before, offsets = 0, []
    for block, n in sizes:
        offsets.append((block, before))
        before += n
    starts = df.sparkSession.createDataFrame(offsets, f"{BLOCK} int, _before long")
    within = F.row_number().over(Window.partitionBy(BLOCK).orderBy(*order, TIE))
    numbered = rows.withColumn("_within", within).join(starts, BLOCK)
    return numbered.select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))


def prefix_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Mapping[str, str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Running sums per key as `running_sum` gives them, for keys that hold any share of the rows; a null key is a key.

    A block may hold the end of one key and the start of the next, a key may fill many blocks. The sums of each key and
    block, as many rows as keys and blocks together at most, are added along the blocks of the key as exact words and
    come back to the rows by a join, so that a sum is rounded once, however it was cut.
    """
    names = list(measures.values())
    own = in_blocks(df, [*keys, *order], block_rows)
    own = own.withColumns({f"_x_{name}": finite(src) for src, name in measures.items()})
    split, words = split_columns(own, [f"_x_{name}" for name in names])
    flat = {f"_w{i}_{name}": w for name in names for i, w in enumerate(words[f"_x_{name}"])}
    rows = split.withColumns(flat).select(*df.columns, BLOCK, TIE, *flat)

    parts = rows.groupBy(*keys, BLOCK).agg(*[F.sum(c).alias(c) for c in flat])
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(BLOCK).alias("_of"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_b{c}") for c in flat],
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({f"_s{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in flat})
    same = F.col(BLOCK) == F.col("_of")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = summed.join(before, same)
    value = {name: joined([F.col(f"_s_w{i}_{name}") + F.col(f"_b_w{i}_{name}") for i in range(WORDS)]) for name in names}
    return out.select(*[c for c in df.columns if c not in value], *[v.alias(name) for name, v in value.items()])
