"""A corpus pipeline: language ID, near-duplicates, decontamination, personal data, tokens.

Each stage takes what its predecessor kept, as written, and its decisions take effect. All but the last return the
columns of documents, under their names and of their types, whatever others the table has.

A document without a text or a letter has no language and goes with the first stage; texts without a word are in no group of
copies and hold no item. Of a group the smallest id stays, a null id being the greatest; of rows that share id and text the
first by their other columns, so repeated rows become one. Null ids are documents like others. Empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm import bpe, decontaminate, language_id, ngram_join, pii
from skuloom.llm.common import LAST, own_folder, table, text_or_empty
from skuloom.llm.queries import WORDS


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is unknown or too close between two. Rows with equal texts fare alike."""
    known = language_id.trained(docs)
    return language_id.accepted(docs, known)


def as_rows(docs: DataFrame, **more: Column) -> DataFrame:
    """Whole documents as the column `row`, beside columns that cannot clash with theirs."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(x.alias(n) for n, x in more.items()))


def sortable(field: T.StructField) -> Column:
    """A column by which rows can be ordered: maps have no order, their text has."""
    column = F.col("row").getField(field.name)
    unordered = any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
    return F.to_json(F.struct(column)) if unordered else column


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: that with the smallest id, of repeated rows the first by its other columns."""
    found = ngram_join.similarity_join(docs).filter("first")
    first = found.select("rank", "hash").distinct()
    own = as_rows(docs, rank=F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), hash=F.xxhash64(text_or_empty()))
    kept = own.join(first, ["rank", "hash"], "left_semi")
    others = [sortable(f) for f in docs.schema if f.name != "text"]
    nth = F.row_number().over(Window.partitionBy("rank", "hash").orderBy(*others))
    return kept.withColumn("nth", nth).filter(F.col("nth") == 1).select("row.*")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    own = F.struct("doc_id", F.xxhash64(text_or_empty()).alias("hash"))
    found = decontaminate.leaks(docs.select(own.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaking = found.select(F.col("doc_id.doc_id").alias("leak"), F.col("doc_id.hash").alias("leak_hash")).distinct()
    rows = as_rows(docs, id=F.col("doc_id"), hash=F.xxhash64(text_or_empty()))
    same = F.col("id").eqNullSafe(F.col("leak")) & (F.col("hash") == F.col("leak_hash"))
    return rows.join(leaking, same, "left_anti").select("row.*")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in the texts; n_chars follows the text where it is known."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts and what they decode to, as counts and digests."""
    return bpe.digest(bpe.encode(docs, WORDS))


STAGES = [
    ("language_id", identified),
    ("ngram_join", unlike),
    ("decontamination", uncontaminated),
    ("pii", redacted),
    ("bpe", encoded),
]

#: Compression sizes and boosted trees are beyond SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = own_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
