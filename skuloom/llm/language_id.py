"""Language identification by compression.

A dictionary of raw training text per language primes a zstandard compressor; a text belongs to the language whose
dictionary makes it smallest. Whole texts are compressed, in blocks, so that a long text does not come to describe itself;
case and all but letters are left out first, as they tell little about the language.

Training. Of the training rows (text, known language) the `SAMPLE_DOCS` documents of each language with the smallest hash
of their id are taken; their texts fill at most `DICTIONARY_BYTES` per language in that order, each giving at most
`SHARE_CHARS` from its middle. These bounds are parameters. The rows to classify have none.

Margin. How narrow a lead is told from the sample itself (`margin_of`): the texts of each language are dealt into two
halves, and the dictionaries of one half are tried on the texts of the other. The leads of right predictions, per byte,
stand against those that texts of a language take when its dictionary is left out. The margin is where at most `LOST` of
the right ones fall below it, or less where less rejects all but `LOST` of the others. With fewer than `LEADS` right ones
it is `MARGIN`.

Results. A text that is null or has no letter is `und` with score 0. The score is the share of the best language in
2^(-bits / TEMPERATURE). Where the best two differ by less than `margin` of the plain size, or by less than `MIN_LEAD`
bytes, as sizes are whole bytes, the prediction is marked as rejected; ties go to the first language by name. With no
training rows everything is `und`.
Repeated rows and repeated or null ids each give a row, further columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.common import fold, light_batches, map_rows, slices

DICTIONARY_BYTES = 98_304
SHARE_CHARS = 2_048
SAMPLE_DOCS = 128
BLOCK_CHARS = 8_192
MARGIN = 0.001
LOST = 0.002
LEADS = 64
MIN_LEAD = 2
TEMPERATURE = 24.0
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
WORD = re.compile(r"[^\W\d_]+")

Dictionaries = tuple[tuple[str, bytes], ...]


def dictionaries(docs: DataFrame, size: int = DICTIONARY_BYTES, share: int = SHARE_CHARS, count: int = SAMPLE_DOCS) -> Dictionaries:
    """(language, raw content) from a bounded sample of the rows (doc_id, text, lang)."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    ranked = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (
        known.select("doc_id", "lang", order.alias("h"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= count)
        .select(F.col("doc_id").alias("p_id"), F.col("lang").alias("p_lang"), "rank")
    )
    # at most `count` rows a language
    middle = F.substring("text", F.greatest(F.lit(1), (F.length("text") - share) / 2).cast("int"), F.lit(share))
    same = F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("lang") == F.col("p_lang"))
    # one text a rank, also where an id repeats
    rows = known.join(F.broadcast(picked), same).groupBy("lang", "rank").agg(F.min(middle).alias("part")).collect()
    parts: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        parts.setdefault(row["lang"], []).append(row["part"])
    # what stands last is nearest to the text and found first
    return tuple((lang, "\n".join(plain(t) for t in reversed(texts)).encode()[-size:]) for lang, texts in sorted(parts.items()))


@functools.lru_cache(maxsize=2)
def compressors(known: Dictionaries) -> tuple[list[str], list[zstandard.ZstdCompressor]]:
    def primed(raw: bytes) -> zstandard.ZstdCompressor:
        # short matches tell languages apart better than the defaults, which look for longer ones
        settings = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=17, hash_log=17, search_log=3, min_match=4, target_length=32,
            strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(compression_params=settings, dict_data=d)

    return [lang for lang, _ in known], [primed(raw) for _, raw in known]


def plain(text: str) -> str:
    """The words of the text in lower case, without what stands between them; a word repeated at once counts once."""
    words = WORD.findall(text.lower())
    return " ".join(w for w, before in zip(words, [None, *words], strict=False) if w != before)


def blocks(text: str, size: int = BLOCK_CHARS) -> list[bytes]:
    return [text[i : i + size].encode() for i in range(0, len(text), size)]


def sizes_of(text: str, known: Dictionaries) -> tuple[np.ndarray, int]:
    """Compressed bytes of the text by language, and its plain bytes."""
    parts = blocks(plain(text))
    return np.array([sum(len(tool.compress(b)) for b in parts) for tool in compressors(known)[1]], dtype=float), sum(map(len, parts))


def halves(known: Dictionaries) -> list[tuple[Dictionaries, list[tuple[int, str]]]]:
    """The dictionaries of each half of the sample's texts, with the texts of the other half and their languages' numbers."""
    texts = [raw.decode(errors="ignore").split("\n") for _, raw in known]
    return [
        (
            tuple((lang, "\n".join(own[half::2]).encode()) for (lang, _), own in zip(known, texts, strict=True)),
            [(k, text) for k, own in enumerate(texts) for text in own[1 - half :: 2] if LETTER.search(text)],
        )
        for half in (0, 1)
    ]


def leads_of(known: Dictionaries) -> tuple[list[float], list[float]]:
    """Leads per byte of right predictions, and of texts whose own language is left out, sorted."""
    right, foreign = [], []
    for half, texts in halves(known):
        for k, text in texts:
            sizes, n = sizes_of(text, half)
            others = np.sort(np.delete(sizes, k))
            if sizes[k] < others[0]:
                right.append((others[0] - sizes[k]) / n)
            if len(others) > 1:
                foreign.append((others[1] - others[0]) / n)
    return sorted(right), sorted(foreign)


@functools.lru_cache(maxsize=4)
def margin_of(known: Dictionaries) -> float:
    """The lead per byte below which a prediction is rejected."""
    if len(known) < 2:
        return MARGIN
    right, foreign = leads_of(known)
    if len(right) < LEADS:
        return MARGIN
    kept = right[int(LOST * len(right))]
    return max(MARGIN, min(kept, foreign[int((1 - LOST) * (len(foreign) - 1))]) if foreign else kept)


def identify(text: str | None, known: Dictionaries, margin: float | None = None) -> tuple[str, float, bool]:
    """Language, score, rejected; without a margin, that of the dictionaries."""
    if not known or text is None or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    margin = margin_of(known) if margin is None else margin
    sizes, n = sizes_of(text, known)
    best = int(sizes.argmin())
    score = float(1 / np.exp2(np.maximum(-1000, (sizes[best] - sizes) * 8 / TEMPERATURE)).sum())
    gap = np.delete(sizes, best).min() - sizes[best] if len(sizes) > 1 else np.inf
    return known[best][0], score, bool(gap < MIN_LEAD or gap < margin * n)


def language_id(docs: DataFrame, known: Dictionaries, margin: float | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` and (doc_id, lang_pred, score, rejected) of every row of (doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    margin = margin_of(known) if margin is None else margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [identify(t, held.value, margin) for t in batch.column(0).to_pylist()]
            columns = batch.columns[1:] + [
                pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    kept = light_batches(docs).select(F.col("text").cast("string").alias("text"), "doc_id", *keep)
    schema = T.StructType(kept.schema.fields[1:]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return kept.mapInArrow(run, schema)


def trained(docs: DataFrame) -> Dictionaries:
    """Dictionaries of the rows outside the held-out fold."""
    return dictionaries(docs.select("doc_id", "text", "lang").filter(fold() != 0))


def accepted(docs: DataFrame, known: Dictionaries, margin: float | None = None) -> DataFrame:
    """The rows, with all their columns, that are not rejected."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    margin = margin_of(known) if margin is None else margin
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not identify(t, held.value, margin)[2] for t in batch.column(place).to_pylist()], pa.bool_()))

    return map_rows(docs, run)
