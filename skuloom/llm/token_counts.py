"""Token counts of whole texts, without keeping a token.

Texts are cut at safe places into segments of a bounded size, segments are gathered into batches of about equal bytes,
and each batch is encoded in one call inside an Arrow function that returns lengths only.

A place is safe if no piece of the vocabulary can reach across it. The model marks a word start with U+2581, puts one
in front of every input, and keeps runs of spaces; where no piece holds U+2581 after another character, a single space
between two other characters is safe: the second part, given without its space, gets the mark that the space would have
become. `safe_spaces` proves this for a model; where it does not hold, texts stay whole.

Null text counts as empty: 0 bytes, 0 tokens. Rows are neither merged nor dropped: repeated rows and repeated or null
ids each give a row. Further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import light_batches, slices, text_or_empty

#: Characters of a segment, bytes of a batch. They bound memory and change no result.
SEGMENT_CHARS = 16_384
BATCH_BYTES = 1_000_000

SAFE_SPACE = re.compile(r"(?<=[^ ▁]) (?=[^ ▁])")
MARK_INSIDE = re.compile("[^▁]▁")


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=2)
def safe_spaces(path: str) -> bool:
    """No piece crosses a word start, and the model changes nothing before it encodes but to mark spaces."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules = model.normalizer_spec
    plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
    return (
        plain and rules.escape_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix
        and not any(" " in p.piece or MARK_INSIDE.search(p.piece) for p in model.pieces)
    )


def segments(text: str, size: int) -> Iterator[str]:
    """Parts of about `size` characters, cut at safe spaces only; the space at a cut belongs to neither part."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def lengths(texts: list[str], path: str, segment_chars: int, batch_bytes: int) -> tuple[list[int], list[int]]:
    """Bytes and tokens of each text."""
    sizes, counts = [0] * len(texts), [0] * len(texts)
    batch, owners, held = [], [], 0

    def flush() -> None:
        for at, ids in zip(owners, encoder(path).encode(batch, num_threads=1), strict=True):
            counts[at] += len(ids)
        batch.clear()
        owners.clear()

    split = safe_spaces(path)
    for at, text in enumerate(texts):
        sizes[at] = len(text.encode())
        for part in segments(text, segment_chars) if split else (text,):
            batch.append(part)
            owners.append(at)
            held += len(part.encode())
            if held >= batch_bytes:
                flush()
                held = 0
    if batch:
        flush()
    return sizes, counts


def token_counts(
    docs: DataFrame, model_path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text",
    segment_chars: int = SEGMENT_CHARS, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row. `model_path` must be readable on every executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, counts = lengths(batch.column(1).to_pylist(), model_path, segment_chars, batch_bytes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=[id_column, "n_bytes", "n_tokens"],
            )

    kept = light_batches(docs).select(F.col(id_column), text_or_empty(text_column).alias("text"))
    kind = kept.schema[0].dataType.simpleString()
    counted = kept.mapInArrow(count, f"`{id_column}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
