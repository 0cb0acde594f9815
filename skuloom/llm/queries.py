"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.llm import alignment as AL
from skuloom.llm import bpe as BP
from skuloom.llm import decontaminate as DC
from skuloom.llm import factorisation as FM
from skuloom.llm import filter_audit as FA
from skuloom.llm import language_id as LI
from skuloom.llm import ngram_join as NJ
from skuloom.llm import pii as PI
from skuloom.llm import quality_rules as QR
from skuloom.llm import simhash_join as SJ
from skuloom.llm import suffix_dedup as SD
from skuloom.llm import token_counts as TC
from skuloom.llm import warc as WA
from skuloom.llm.common import fold, table

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DC.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start_word", "n_words")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SD.digest(SD.remove_repeats(table(spark, sf_dir, "documents")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WA.revisit_table(table(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BP.digest(BP.encode(table(spark, sf_dir, "documents"), WORDS))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PI.digest(PI.find_spans(table(spark, sf_dir, "documents")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = NJ.similarity_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "set_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TC.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = LI.language_id(docs.withColumn("held_out", fold() == 0), LI.trained(docs), keep=("held_out",))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FM.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    found = QR.quality_verdicts(table(spark, sf_dir, "documents"))
    return found.select(*first, F.round("posterior", 4).alias("posterior"), *(c for c in found.columns if c.startswith("vote_")))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AL.align(table(spark, sf_dir, "documents"), BYTES, PIECES)[0]


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SJ.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FA.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_suffix_dedup, op3_warc, op4_bpe, op5_pii, op6_ngram_join, op7_token_counts,
        op8_language_id, op9_quality_classifier, op10_quality_rules, op11_alignment, op12_simhash, op13_filter_audit,
    )
}
