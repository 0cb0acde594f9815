"""Quality scores by a factorisation machine.

Inputs of a text are hashed words, hashed word endings (the marks behind a word), statistics of its structure, and
numeric metadata columns. The machine adds a weight per input and a low-rank weight per pair of inputs; the pairs are
summed in linear time as half of (square of the sum - sum of the squares) per factor.

Fitting takes the `SAMPLE_ROWS` labelled documents with the smallest hash of their id (a parameter); features are made
by Spark, the fit on that bounded sample runs in numpy. Scoring covers every row and the whole text of each.

Null text counts as empty and gets a score from its statistics alone. Null or missing metadata counts as 0. Labels other
than 0 and 1 and labels of unknown documents are not used; several labels of a document all are. Without labels of both
kinds the score is the share of label 1, one half if there are none. Repeated rows and repeated or null ids each give a
row; of several texts under one labelled id the smallest is learned. Further columns are ignored.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.common import fold, light_batches, slices, text_or_empty

WORD_BITS, ENDING_BITS = 14, 8
FACTORS = 8
SAMPLE_ROWS = 6_000
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.01, 1e-4
CUT = 0.3
CACHE_WORDS = 100_000
CORE = re.compile(r"(.*?)(\W*)", re.DOTALL)
SYMBOLS = b"#*$%&|<>"
STATISTICS = 16


class Buckets(dict):
    """Word to hashed buckets of its core and of its ending (0: none), kept for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        core, ending = CORE.fullmatch(word).groups()
        found = zlib.crc32(core.lower().encode("utf-8", "replace")) & ((1 << WORD_BITS) - 1)
        if ending:
            found |= (1 + zlib.crc32(ending.encode("utf-8", "replace")) % ((1 << ENDING_BITS) - 1)) << WORD_BITS
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found


def size(metadata: int) -> int:
    """Number of inputs."""
    return (1 << WORD_BITS) + (1 << ENDING_BITS) + STATISTICS + metadata


def features(text: str, metadata: tuple[float, ...], buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the inputs that are not 0; statistics and metadata always stand last."""
    words = text.split()
    n = len(words)
    codes = np.fromiter(map(buckets.__getitem__, words), np.int32, n)
    cores, endings = codes & ((1 << WORD_BITS) - 1), codes >> WORD_BITS
    core_ids, core_n = np.unique(cores, return_counts=True)
    ending_ids, ending_n = np.unique(endings[endings > 0], return_counts=True)
    raw = text.encode("utf-8", "replace")
    chars, some = max(1, len(raw)), max(1, n)

    def share(marks: bytes) -> float:
        return (len(raw) - len(raw.translate(None, marks))) / chars

    lines = [line for line in text.split("\n") if line.strip()]
    statistics = (
        np.log1p(n) / 10, len(text) / some / 20, len(core_ids) / np.sqrt(some) / 20,
        (core_n.max() / n) if n else 0.0, np.count_nonzero(codes[1:] == codes[:-1]) / some,
        1 - len(set(lines)) / len(lines) if lines else 0.0, len(lines) / some,
        np.count_nonzero(endings) / some, share(SYMBOLS) * 4, share(b"!?") * 4, share(b".,;:"),
        share(string.ascii_uppercase.encode()), share(string.digits.encode()),
        (core_n * core_n).sum() / (some * some), float(n < 20), float(n < 5),
    )

    def scaled(counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts)
        return x / max(1e-9, np.sqrt((x * x).sum()))

    first = (1 << WORD_BITS) + (1 << ENDING_BITS)
    ids = np.concatenate([core_ids, ending_ids + (1 << WORD_BITS), np.arange(first, first + STATISTICS + len(metadata))])
    return ids.astype(np.int32), np.concatenate([scaled(core_n), scaled(ending_n), statistics, metadata]).astype(np.float32)


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log odds of rows given one behind the other; each has an input."""
        part = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(part, starts)
        squares = np.add.reduceat((part * part).sum(1), starts)
        return self.bias + np.add.reduceat(self.weights[ids] * values, starts) + 0.5 * ((sums * sums).sum(1) - squares)

    def score(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(ids, values, starts), -40, 40).astype(float)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, inputs: int, seed: int = 7) -> Machine:
    """Logistic loss, minibatches with Adam, weights decay."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Machine(float(np.log(share / (1 - share))), np.zeros(inputs, np.float32), np.zeros((inputs, 1), np.float32))
    random = np.random.default_rng(seed)
    # column 0 holds the weights, the others the factors
    theta = np.concatenate([np.zeros((inputs, 1)), random.normal(0, 0.05, (inputs, FACTORS))], 1).astype(np.float32)
    bias, bias_m, bias_v = float(np.log(share / (1 - share))), 0.0, 0.0
    m, v, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            picked = order[at : at + BATCH]
            ids = np.concatenate([rows[i][0] for i in picked])
            x = np.concatenate([rows[i][1] for i in picked])
            lengths = np.array([len(rows[i][0]) for i in picked])
            starts = np.concatenate([[0], lengths.cumsum()[:-1]])
            owner = np.repeat(np.arange(len(picked)), lengths)
            part = theta[ids, 1:] * x[:, None]
            sums = np.add.reduceat(part, starts)
            z = bias + np.add.reduceat(theta[ids, 0] * x, starts)
            z = z + 0.5 * ((sums * sums).sum(1) - np.add.reduceat((part * part).sum(1), starts))
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[picked]) / len(picked)
            pull = (error[owner] * x).astype(np.float32)
            used, slot = np.unique(ids, return_inverse=True)
            slopes = np.concatenate([pull[:, None], pull[:, None] * (sums[owner] - part)], 1)
            gradient = np.stack([np.bincount(slot, slopes[:, f], len(used)) for f in range(FACTORS + 1)], 1)
            gradient = (gradient + DECAY * theta[used]).astype(np.float32)
            step += 1
            m[used] = 0.9 * m[used] + 0.1 * gradient
            v[used] = 0.99 * v[used] + 0.01 * gradient * gradient
            theta[used] -= RATE * (m[used] / (1 - 0.9**step)) / (np.sqrt(v[used] / (1 - 0.99**step)) + 1e-8)
            bias_m, bias_v = 0.9 * bias_m + 0.1 * error.sum(), 0.99 * bias_v + 0.01 * error.sum() ** 2
            bias -= RATE * (bias_m / (1 - 0.9**step)) / (np.sqrt(bias_v / (1 - 0.99**step)) + 1e-8)
    return Machine(float(bias), theta[:, 0].copy(), theta[:, 1:].copy())


def inputs_of(docs: DataFrame, metadata: tuple[str, ...]) -> DataFrame:
    """doc_id, text and an array of the metadata, on a log scale."""
    known = [
        F.signum(c) * F.log1p(F.abs(c)) / 20 if name in docs.columns else F.lit(0.0)
        for name in metadata
        for c in [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in docs.columns else F.lit(0.0)]
    ]
    numbers = F.array(*known).cast("array<double>") if known else F.array().cast("array<double>")
    return light_batches(docs).select("doc_id", text_or_empty().alias("text"), numbers.alias("metadata"))


def learn(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",), sample: int = SAMPLE_ROWS) -> Machine:
    """Fit on the bounded sample of (doc_id, quality)."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    picked = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("l_id"), F.col("quality").cast("double").alias("quality"), order.alias("h"))
        .orderBy("h", "l_id", "quality").limit(sample)
    )
    # at most `sample` rows are broadcast
    known = docs.join(F.broadcast(picked.select("l_id").distinct()), F.col("doc_id") == F.col("l_id"), "left_semi")
    single = (
        inputs_of(known, metadata).groupBy("doc_id")
        .agg(F.min_by(F.struct("text", "metadata"), F.struct("text", "metadata")).alias("x"))
        .select("doc_id", "x.*")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in slices(batches):
            found = [
                features(t, tuple(numbers), buckets)
                for t, numbers in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.list_(pa.int32()), pa.list_(pa.float32()))))],
                names=["doc_id", "ids", "x"],
            )

    kind = single.schema["doc_id"].dataType.simpleString()
    made = single.mapInArrow(extract, f"doc_id {kind}, ids array<int>, x array<float>")
    rows = (
        made.join(F.broadcast(picked), F.col("doc_id") == F.col("l_id"))
        .select("h", "l_id", "quality", "ids", "x").toArrow().sort_by([("h", "ascending"), ("l_id", "ascending"), ("quality", "ascending")])
    )
    pairs = [
        (np.asarray(i.values), np.asarray(x.values))
        for i, x in zip(rows["ids"].combine_chunks(), rows["x"].combine_chunks(), strict=True)
    ]
    return fit(pairs, rows["quality"].to_numpy(), size(len(metadata)))


def scores(docs: DataFrame, machine: Machine, metadata: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """(doc_id, score) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in slices(batches):
            found: list[float] = []
            rows, held_inputs = [], 0

            def flush(rows: list, found: list[float]) -> None:
                starts = np.cumsum([0, *(len(r[0]) for r in rows[:-1])])
                found.extend(held.value.score(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), starts))
                rows.clear()

            for t, numbers in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows.append(features(t, tuple(numbers), buckets))
                held_inputs += len(rows[-1][0])
                if held_inputs > 500_000:
                    flush(rows, found)
                    held_inputs = 0
            if rows:
                flush(rows, found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = inputs_of(docs, metadata)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"]]).add("score", "double"))


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted); learned outside the held-out fold."""
    machine = learn(docs, labels.filter(fold() != 0))
    return scores(docs, machine).select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )
