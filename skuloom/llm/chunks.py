"""Documents in chunks of bounded size, for operators that work on many texts at once."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.common import give_back, light_batches, text_or_empty, total_bytes


def packed(*parts: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def in_chunks(docs: DataFrame, chunk_bytes: int, total: int | None = None) -> DataFrame:
    """(chunk, ids, texts): documents in chunks of about `chunk_bytes`, or one text that is longer.

    The chunk is a hash of the row, so that a task that runs again finds the same rows. The number of chunks follows the
    size of the table, which is summed first unless given. The documents that one Arrow batch holds of a chunk travel as
    one row, their texts compressed. Null texts are empty.
    """
    total = total_bytes(docs) if total is None else total
    n = max(1, math.ceil(total / chunk_bytes))
    text = text_or_empty()
    rows = light_batches(docs).select(
        "doc_id", text.alias("text"), F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(n)).cast("long").alias("chunk")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(2).to_numpy()
            if not len(chunks):
                continue
            order = np.argsort(chunks, kind="stable")
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            starts = np.flatnonzero(np.append(True, np.diff(chunks[order]) != 0))
            groups = np.split(order, starts[1:])
            ids = pa.ListArray.from_arrays(np.append(starts, len(order)).astype(np.int32), batch.column(0).take(pa.array(order)))
            blobs = [
                packed(np.array([len(g), *(len(texts[i]) for i in g)], "<i8").tobytes(), *(texts[i] for i in g.tolist()))
                for g in groups
            ]
            yield pa.RecordBatch.from_arrays([pa.array(chunks[order][starts]), ids, pa.array(blobs, pa.binary())], names=["chunk", "ids", "texts"])
            give_back()

    result = T.StructType().add("chunk", "long").add("ids", T.ArrayType(rows.schema["doc_id"].dataType)).add("texts", "binary")
    return rows.mapInArrow(pack, result)


def documents(rows: pa.Table) -> tuple[pa.Array, list[bytes]]:
    """Ids and texts of a chunk, ordered by text: the same in every pass, in whichever order the shuffle brought them."""
    texts: list[bytes] = []
    for blob in rows["texts"].to_pylist():
        raw = unpacked(blob)
        sizes = np.frombuffer(raw, "<i8", int(np.frombuffer(raw, "<i8", 1)[0]), 8)
        ends = 8 + 8 * len(sizes) + np.cumsum(sizes)
        texts += [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
    ids = pa.concat_arrays([c.flatten() for c in rows["ids"].chunks])
    order = sorted(range(len(texts)), key=texts.__getitem__)
    return ids.take(pa.array(order, pa.int64())), [texts[i] for i in order]
