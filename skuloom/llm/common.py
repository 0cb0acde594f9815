"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import functools
import inspect
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


#: Stands for a null id where ids are ordered: after all others.
LAST = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, where that is unset, gets a
    temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="skuloom-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this call inside the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder; later steps read them from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 is the held-out fold. A null id is in no fold and counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(0))


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(column))).alias("n")).first()["n"] or 0


#: Rows in an Arrow batch of texts, and the setting with its default.
BATCH_ROWS = 1_000
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def light_batches(df: DataFrame) -> DataFrame:
    """The same DataFrame. Where the session has Spark's default, texts go to Python a thousand rows at a time: the
    buffers of ten thousand long texts, twice a task, weigh more than the work itself."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df


def map_rows(df: DataFrame, function: Callable) -> DataFrame:
    """mapInArrow from whole rows to rows of the same columns, which it sees by position: their names may hold dots."""
    plain = light_batches(df).toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.mapInArrow(function, plain.schema).toDF(*df.columns)


@functools.lru_cache(maxsize=1)
def _heap_trimmer():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives through many tasks, and keeps its largest heap otherwise."""
    pa.default_memory_pool().release_unused()
    trim = _heap_trimmer()
    if trim is not None:
        trim(0)


def thrifty(function: Callable) -> Callable:
    """A function on the rows of a group, which gives its memory back."""

    def run(*tables: pa.Table) -> pa.Table:
        try:
            return function(*tables)
        finally:
            give_back()

    # Spark tells the forms of a grouped function apart by its parameters
    run.__signature__ = inspect.signature(function)
    return run


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: texts become Python objects, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        give_back()
