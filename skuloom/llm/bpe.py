"""BPE encoding and decoding by a table of distinct words.

Texts are split at white space, which the tokenizer drops, so that a text's ids are those of its words one behind the
other. Documents are dealt into chunks. Each chunk sends its distinct words to buckets by hash; a bucket encodes each
distinct word once, however many chunks hold it, and sends the ids back; the chunk puts them in place of the words by
position. Decoding looks each id up in the id-to-piece table, which is bounded by the vocabulary file, once per distinct
word of a chunk, and joins the pieces as the library does for a tokenizer without a decoder: by a space.

A frequent word is sent once per chunk, never once per occurrence. Words and ids travel as compressed lists.

Null text counts as empty: no ids, empty decoded text. Repeated rows and repeated or null ids each give a row. Further
columns are ignored. A tokenizer whose rules reach across white space is refused.
"""

from __future__ import annotations

import functools
import json
import math
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.chunks import documents, in_chunks, packed, unpacked
from skuloom.llm.common import slices, thrifty, total_bytes

CHUNK_BYTES = 6_000_000
#: Input bytes per bucket of words.
BUCKET_BYTES = 16_000_000
ENCODE_BATCH = 5_000


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> dict[int, bytes]:
    """The id-to-piece table, added tokens included."""
    return {i: piece.encode() for piece, i in tokenizer(path).get_vocab(with_added_tokens=True).items()}


def check(path: str) -> None:
    """Words may be encoded one by one only if white space is dropped and nothing else joins two of them."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = next((s for s in steps if s.get("type") == "Split"), {})
    dropped = split.get("behavior") == "Removed" and split.get("invert") and "[^\\s" in split["pattern"].get("Regex", "")
    if not dropped or told.get("decoder") or told.get("post_processor") or any(" " in t["content"] for t in told["added_tokens"]):
        raise ValueError(f"{path}: words cannot be encoded one by one")


def vocabulary(texts: list[bytes], buckets: int) -> tuple[dict[bytes, int], np.ndarray]:
    """The code of each distinct word of the texts, in the order of appearance, and its bucket."""
    words = dict.fromkeys(chain.from_iterable(map(bytes.split, texts)))
    codes = dict(zip(words, range(len(words)), strict=True))
    return codes, np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def coded(words: list[bytes], codes: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.int64, len(words))


def dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Codes of each bucket, in order."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order])) + 1
    for own in np.split(order, ends) if len(order) else ():
        yield int(bucket[own[0]]), own


def joined(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The slices of `flat` that the picked codes stand for, one behind the other."""
    n = counts[picked]
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[picked] - (ends - n), n)]


def width(path: str) -> str:
    """Type in which ids travel."""
    return "<u2" if max(pieces(path)) < 1 << 16 else "<u4"


def encode_words(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, one behind the other, and their numbers."""
    flat, counts = [], []
    for at in range(0, len(words), ENCODE_BATCH):
        texts = [w.decode() for w in words[at : at + ENCODE_BATCH]]
        found = [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]
        counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
    return np.concatenate(flat), np.concatenate(counts)


@functools.lru_cache(maxsize=2)
def piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id-to-piece table as bytes, each piece behind a space, with starts and lengths by id."""
    table = pieces(path)
    texts = [b" " + table.get(i, b"") for i in range(max(table) + 1)]
    sizes = np.array(list(map(len, texts)), np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def decoded(ids: np.ndarray, counts: np.ndarray, path: str) -> pa.Array:
    """The pieces of each text's ids, joined by a space; `ids` holds the texts one behind the other."""
    data, starts, sizes = piece_bytes(path)
    parts, ends = [], np.cumsum(counts)
    for lo, hi in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        # the space before the first piece does not belong to the text
        parts.append(joined(data, starts, sizes, ids[lo:hi])[1:].tobytes())
    return pa.array(parts, pa.binary()).cast(pa.string())


def encode(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: ids packed as little-endian unsigned 32-bit integers."""
    check(path)
    total = total_bytes(docs)
    buckets = max(1, math.ceil(total / bucket_bytes))
    chunked = in_chunks(docs, chunk_bytes, total)
    kind = width(path)

    def send(rows: pa.Table) -> pa.Table:
        codes, bucket = vocabulary(documents(rows)[1], buckets)
        words = list(codes)
        found = [(b, packed(b"\n".join(map(words.__getitem__, own.tolist())), level=3)) for b, own in dealt(bucket)]
        chunk = rows["chunk"][0].as_py()
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in found], pa.int64()), "chunk": pa.array([chunk] * len(found), pa.int64()),
                "words": pa.array([w for _, w in found], pa.binary()),
            }
        )

    def answer(rows: pa.Table) -> pa.Table:
        lists = [unpacked(w).split(b"\n") for w in rows["words"].to_pylist()]
        words = dict.fromkeys(chain.from_iterable(lists))
        flat, counts = encode_words(list(words), path)
        starts = np.cumsum(counts) - counts
        codes = dict(zip(words, range(len(words)), strict=True))
        blobs = []
        for own in lists:
            picked = coded(own, codes)
            blobs.append(packed(counts[picked].astype("<u4").tobytes(), joined(flat, starts, counts, picked).astype(kind).tobytes(), level=3))
        return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"], "ids": pa.array(blobs, pa.binary())})

    def place(rows: pa.Table, answers: pa.Table) -> pa.Table:
        doc_ids, texts = documents(rows)
        codes, bucket = vocabulary(texts, buckets)
        told = dict(zip(answers["bucket"].to_pylist(), answers["ids"].to_pylist(), strict=True))
        counts, starts = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        flat, at = [], 0
        for b, own in dealt(bucket):
            raw = unpacked(told[b])
            n = np.frombuffer(raw, "<u4", len(own)).astype(np.int64)
            flat.append(np.frombuffer(raw, kind, offset=4 * len(own)).astype("<u4"))
            counts[own], starts[own] = n, at + np.cumsum(n) - n
            at += len(flat[-1])
        every = np.concatenate(flat) if flat else np.zeros(0, "<u4")
        ids = [joined(every, starts, counts, coded(text.split(), codes)) for text in texts]
        sizes = np.array(list(map(len, ids)), np.int64)
        return pa.table(
            {
                "doc_id": doc_ids, "n_tokens": pa.array(sizes), "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
                "decoded": decoded(np.concatenate(ids), sizes, path),
            }
        )

    sent = chunked.groupBy("chunk").applyInArrow(thrifty(send), "bucket long, chunk long, words binary")
    answers = sent.groupBy("bucket").applyInArrow(thrifty(answer), "chunk long, bucket long, ids binary")
    doc_id = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    result = T.StructType([doc_id]).add("n_tokens", "long").add("ids", "binary").add("decoded", "string")
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(thrifty(place), result)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded) from (doc_id, ids) with packed ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = [np.frombuffer(b or b"", "<u4") for b in batch.column(1).to_pylist()]
            sizes = np.array(list(map(len, lists)), np.int64)
            texts = decoded(np.concatenate(lists), sizes, path) if lists else pa.array([], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"]]).add("decoded", "string"))


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
