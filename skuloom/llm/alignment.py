"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often, over the whole corpus.

A text is encoded by both tokenizers and cut into groups at the byte offsets where tokens of both end; two tokens are linked
where their byte ranges overlap. Links are counted by pair of ids over all documents:

1. Documents are dealt into chunks of bounded size. A chunk counts the links of its pairs and sends the pairs, by hash, to
   blocks; their number follows the table up to what the product of the vocabularies can fill (`BLOCK_PAIRS` a block).
2. A block's distinct pairs are united in a tree: `FAN` chunks at a time, then `FAN` of the results, and so on. The last step
   builds a minimal perfect hash of them (`perfect_hash`) and lays the pairs down in its order.
3. Chunks' counts become dense vectors indexed by that hash, the stored pair verified, and are summed in the same tree.
4. The highest count of each B id is one number per entry of the vocabulary.
5. Second pass: chunks look the counts of their pairs up in the blocks, `FAN` chunks at a time against a copy of the block,
   and align their documents again, from the tokens that the first pass has written down.

No group holds more than `FAN` rows of a block or the documents of one chunk, however often a pair or text occurs.

Both tokenizers cut texts before a single space between two characters that are neither white space nor U+2581, and their
tokens do not reach across (`check` proves it for the files), so a text's tokens are those of its units between such
spaces one behind the other. A chunk aligns each distinct unit once.

Texts that are null or empty, or that the tokens of either tokenizer do not give back (a U+2581 reads as a space), have no
tokens: all counts are 0, the digest is ''. Rows are neither merged nor dropped: repeated rows and repeated or null ids each
give a row and count each. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.llm.bpe import joined
from skuloom.llm.chunks import documents, in_chunks, packed, unpacked
from skuloom.llm.common import checkpointed, thrifty, total_bytes
from skuloom.llm.perfect_hash import PerfectHash, mixed, perfect_hash
from skuloom.llm.token_counts import encoder, safe_spaces

CHUNK_BYTES = 12_000_000
#: Input bytes per block of pairs, and the pairs a block gets if all that the vocabularies allow occur.
BLOCK_BYTES = 32_000_000
BLOCK_PAIRS = 1 << 16
#: Chunks, or sums of them, that meet in one group.
FAN = 64
#: Units encoded as one text, texts in a call.
JOINED = 500
BATCH = 20
#: Tokens written as text at once.
STEP = 100_000
#: Stands for a block where a chunk's tokens travel.
TOKENS = -1

UNIT_END = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: Bits of a pair that hold the B id.
B_BITS = 32
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow
    from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def byte_level(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    # the strings of special tokens are plain text
    found.encode_special_tokens = True
    return found


@functools.lru_cache(maxsize=2)
def bytes_a(path: str) -> list[bytes]:
    """The bytes of each id of the byte-level tokenizer."""
    codes, vocabulary = byte_characters(), byte_level(path).get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        found[i] = bytes(codes[c] for c in piece) if all(c in codes for c in piece) else piece.encode()
    return found


@functools.lru_cache(maxsize=2)
def bytes_b(path: str) -> list[bytes]:
    """The bytes of each id of the piece tokenizer."""
    model, found = encoder(path), []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        code = BYTE_PIECE.fullmatch(piece) if model.is_byte(i) else None
        found.append(bytes([int(code[1], 16)]) if code else piece.replace("▁", " ").encode())
    return found


def check(path_a: str, path_b: str) -> None:
    """Units may be encoded one by one only if neither tokenizer changes the text or reaches across their ends."""
    with open(path_a, encoding="utf-8") as f:
        told = json.load(f)
    steps, model = told.get("pre_tokenizer") or {}, told["model"]
    plain = (
        told.get("normalizer") is None and told.get("post_processor") is None and model["type"] == "BPE"
        and steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space")
        and not model.get("dropout") and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        and all(t["special"] for t in told["added_tokens"])
    )
    if not plain or not safe_spaces(path_b):
        raise ValueError(f"{path_a}, {path_b}: texts cannot be encoded unit by unit")


class Aligned(NamedTuple):
    """Alignments of units, one behind the other: per unit its tokens, groups and links, and in `pairs` the links themselves.

    `ids` and `ends` are the tokens of each side and their ends in the joined bytes, `common` the ends of the groups,
    `unit_ends` those of the units. `units` names the units that both tokenizers give back.
    """

    units: list[str]
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    ids: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    common: np.ndarray
    unit_ends: np.ndarray


class Tokens(NamedTuple):
    """Ids of units one behind the other, and which units they are."""

    kept: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray

    def packed(self) -> bytes:
        return blob(np.concatenate([list(map(len, self)), *self]).astype(np.uint64))

    @staticmethod
    def unpacked(data: bytes) -> Tokens:
        told = numbers(data).astype(np.int64)
        return Tokens(*np.split(told[3:], np.cumsum(told[:2])))


def odd(unit: str) -> bool:
    """Whether a unit may not stand beside others: it begins or ends in white space, or may not come back whole."""
    return not unit or len(unit.strip()) < len(unit) or "▁" in unit


def encoded(strings: list[str], path_a: str, path_b: str) -> Iterator[tuple[list[int], list[int]] | None]:
    """Ids of both tokenizers, None where the bytes of either are not those of the text with its space."""
    found_a = byte_level(path_a).encode_batch_fast([" " + s for s in strings], add_special_tokens=False)
    found_b = encoder(path_b).encode(strings, num_threads=1)
    for text, a, ids_b in zip(strings, found_a, found_b, strict=True):
        ids_a, whole = a.ids, b" " + text.encode()
        sides = ((bytes_a(path_a), ids_a), (bytes_b(path_b), ids_b))
        yield (ids_a, ids_b) if all(b"".join(map(table.__getitem__, ids)) == whole for table, ids in sides) else None


def tokens_of(units: Sequence[str], path_a: str, path_b: str) -> Tokens:
    """Encode distinct units, many in a call. Units that a tokenizer changes are left out."""
    alone = [i for i, u in enumerate(units) if odd(u)]
    apart = set(alone)
    plain = [i for i in range(len(units)) if i not in apart]
    # numbers in place of Python's integers, which weigh five times as much
    kept, sides = [], ([], [])

    def take(groups: list[list[int]]) -> list[int]:
        """Encode the groups, units joined by spaces; the units of those that do not come back whole."""
        changed = []
        texts = [" ".join([units[i] for i in g]) for g in groups]
        for group, ids in zip(groups, encoded(texts, path_a, path_b), strict=True):
            if ids is None:
                changed += group
                continue
            kept.append(np.array(group, np.int32))
            for side, own in zip(sides, ids, strict=True):
                side.append(np.array(own, np.int32))
        return changed

    for at in range(0, len(plain), BATCH * JOINED):
        alone += take([plain[i : i + JOINED] for i in range(at, min(at + BATCH * JOINED, len(plain)), JOINED)])
    for at in range(0, len(alone), BATCH):
        take([[i] for i in alone[at : at + BATCH]])
    return Tokens(*(np.concatenate([np.zeros(0, np.int32), *x]).astype(np.int64) for x in (kept, *sides)))


def aligned(kept: list[str], ids: tuple[np.ndarray, np.ndarray], path_a: str, path_b: str) -> Aligned:
    """Align units from their tokens."""
    ends = tuple(np.cumsum(lengths(table)[i]) for table, i in zip((bytes_a(path_a), bytes_b(path_b)), ids, strict=True))
    unit_ends = np.cumsum(np.fromiter((len(u.encode()) + 1 for u in kept), np.int64, len(kept)))
    both = np.sort(np.concatenate(ends), kind="stable")
    again = np.zeros(len(both), bool)
    again[:-1] = both[1:] == both[:-1]
    common, cuts = both[again], both[~again]
    # units end where tokens of both sides do
    if not np.isin(unit_ends, common, assume_unique=True).all():
        raise ValueError("tokens reach across units")

    def per_unit(places: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(unit_ends, places), minlength=len(kept))

    # between two cuts lies one token of each side, and every overlap is one such piece
    a, b = (i[np.searchsorted(e, cuts)].astype(np.uint64) for i, e in zip(ids, ends, strict=True))
    counts = (per_unit(p) for p in (*ends, common, cuts))
    return Aligned(kept, *counts, a << np.uint64(B_BITS) | b, ids, ends, common, unit_ends)


def group_texts(found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """The groups of all units as bytes, each with a ";" behind it, and the bytes of each unit."""
    side = np.repeat([0, 1], [len(i) for i in found.ids])
    ids, ends = np.concatenate(found.ids), np.concatenate(found.ends)
    place = 2 * np.searchsorted(found.common, ends) + side
    order = np.argsort(place, kind="stable")
    ids, place, ends = ids[order], place[order], ends[order]
    behind = np.where(place % 2 == 0, ord("|"), ord(";")).astype(np.uint8)
    behind[:-1][place[1:] == place[:-1]] = ord(",")
    del place, order
    data, starts, sizes = decimals(int(ids.max()) + 1 if len(ids) else 0)
    parts = [np.zeros(0, np.uint8)]
    # the places of the bytes weigh far more than the bytes
    for at in range(0, len(ids), STEP):
        own = ids[at : at + STEP]
        parts.append(joined(data, starts, sizes, own))
        parts[-1][np.cumsum(sizes[own]) - 1] = behind[at : at + STEP]
    per_unit = np.zeros(len(found.units), np.int64)
    np.add.at(per_unit, np.searchsorted(found.unit_ends, ends), sizes[ids])
    return np.concatenate(parts), per_unit


@functools.lru_cache(maxsize=2)
def decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers below n as text, each with a place for one more character, with starts and lengths."""
    texts = [b"%d," % i for i in range(n)]
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def lengths(table: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(len, table), np.int64, len(table))


def split(texts: Sequence[bytes]) -> list[list[str] | None]:
    """The units of every text, None for an empty one."""
    parts = [t.decode().split(" ") if t else None for t in texts]
    # most texts may be cut at every space; where one is no safe place, a part begins or ends beside it
    unsafe = {u for u in set(chain.from_iterable(p for p in parts if p)) if odd(u)}
    return [p if not p or unsafe.isdisjoint(p) else UNIT_END.split(t.decode()) for p, t in zip(parts, texts, strict=True)]


def distinct_units(parts: list[list[str] | None]) -> list[str]:
    return sorted(set(chain.from_iterable(p for p in parts if p)))


def placed(parts: list[list[str] | None], units: list[str], tokens: Tokens, path_a: str, path_b: str) -> tuple[list[np.ndarray | None], Aligned]:
    """The numbers of each text's units among the aligned ones, None for texts without tokens. Empties `parts`."""
    kept = [units[i] for i in tokens.kept.tolist()]
    number = dict(zip(kept, range(len(kept)), strict=True))
    # a tokenizer that changes a unit shortens it: what it gives back cannot be the text
    found: list[np.ndarray | None] = []
    for i, p in enumerate(parts):
        whole = p and (len(kept) == len(units) or all(map(number.__contains__, p)))
        found.append(np.fromiter(map(number.__getitem__, p), np.int32, len(p)) if whole else None)
        # the units of the text are not needed any more
        parts[i] = None
    return found, aligned(kept, tokens[1:], path_a, path_b)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    values, at = np.unique(keys, return_inverse=True)
    found = np.zeros(len(values), np.int64)
    np.add.at(found, at, counts)
    return values, found


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(keys, -1) % np.uint64(blocks)).astype(np.int64)


def blob(values: np.ndarray) -> bytes:
    """Numbers, compressed; ascending ones and counts hold few distinct bytes in the same places."""
    raw = np.ascontiguousarray(values.astype("<u8"))
    return packed(raw.view(np.uint8).reshape(-1, 8).T.tobytes(), level=3)


def numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(unpacked(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<u8").ravel().astype(np.uint64)


def ascending(keys: np.ndarray) -> bytes:
    return blob(np.diff(keys, prepend=np.uint64(0)))


def ascended(data: bytes) -> np.ndarray:
    return np.cumsum(numbers(data), dtype=np.uint64)


def dealt(keys: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each block; keys that ascend do so in their block."""
    block = block_of(keys, blocks)
    order = np.argsort(block, kind="stable")
    ends = np.flatnonzero(np.diff(block[order])) + 1
    for own in np.split(order, ends) if len(order) else ():
        yield int(block[own[0]]), own


def tree(rows: DataFrame, step, groups: int, schema: str, fan: int, last=None) -> DataFrame:
    """Join rows (block, grp, ...) in groups of (block, grp), `fan` groups into one at every further level, to a row a block."""
    while True:
        final = groups <= 1
        run = last if final and last is not None else step
        rows = rows.groupBy("block", "grp").applyInArrow(thrifty(run), schema)
        if final:
            return rows
        groups = -(-groups // fan)
        rows = rows.withColumn("grp", F.floor(F.col("grp") / fan).cast("long"))


def pair_table(sent: DataFrame, chunks: int, fan: int) -> DataFrame:
    """(block, hash, pairs, counts) from the pairs that chunks sent: the pairs in the order of their hash, with their counts."""
    groups = max(1, -(-chunks // fan))
    grouped = sent.withColumn("grp", F.floor(F.col("chunk") / fan).cast("long"))

    def first(rows: pa.Table, key: str):
        return rows[key].slice(0, 1)

    def united(rows: pa.Table) -> np.ndarray:
        return np.unique(np.concatenate([ascended(p) for p in rows["pairs"].to_pylist()]))

    def unite(rows: pa.Table) -> pa.Table:
        return pa.table({"block": first(rows, "block"), "grp": first(rows, "grp"), "hash": pa.nulls(1, pa.binary()), "pairs": [ascending(united(rows))]})

    def build(rows: pa.Table) -> pa.Table:
        keys = united(rows)
        function = perfect_hash(keys)
        laid = np.empty_like(keys)
        laid[function.lookup(keys)] = keys
        return pa.table({"block": first(rows, "block"), "grp": first(rows, "grp"), "hash": [packed(function.packed())], "pairs": [blob(laid)]})

    kind = "block long, grp long, hash binary, pairs binary"
    functions = tree(grouped.select("block", "grp", "pairs"), unite, groups, kind, fan, last=build)
    functions = checkpointed(functions.select("block", "hash", "pairs"))

    def count(rows: pa.Table, function: pa.Table) -> pa.Table:
        table = Table(function["hash"][0].as_py(), function["pairs"][0].as_py())
        dense = np.zeros(len(table.pairs), np.int64)
        for pairs, counts in zip(rows["pairs"].to_pylist(), rows["counts"].to_pylist(), strict=True):
            # a chunk's pairs are distinct
            dense[table.places(ascended(pairs))] += numbers(counts).astype(np.int64)
        return pa.table({"block": first(rows, "block"), "grp": first(rows, "grp"), "counts": [blob(dense)]})

    def add(rows: pa.Table) -> pa.Table:
        total = sum(numbers(c).astype(np.int64) for c in rows["counts"].to_pylist())
        return pa.table({"block": first(rows, "block"), "grp": first(rows, "grp"), "counts": [blob(total)]})

    kind = "block long, grp long, counts binary"
    dense = grouped.groupBy("block", "grp").cogroup(copies(functions, groups).groupBy("block", "grp"))
    dense = dense.applyInArrow(thrifty(lambda a, b: count(a, b) if a.num_rows else empty(kind)), kind)
    dense = dense.withColumn("grp", F.floor(F.col("grp") / fan).cast("long"))
    vectors = tree(dense, add, -(-groups // fan), kind, fan)
    return functions.join(vectors.select("block", "counts"), "block")


def copies(blocks: DataFrame, groups: int) -> DataFrame:
    """A copy of each block for every group of chunks."""
    return blocks.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))


def empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.table({n: pa.array([], kinds[k]) for n, k in (f.strip().split(" ") for f in schema.split(","))})


class Table:
    """The pairs of a block by their hash."""

    def __init__(self, function: bytes, pairs: bytes) -> None:
        self.hash, self.pairs = PerfectHash.unpacked(unpacked(function)), numbers(pairs)

    def places(self, keys: np.ndarray) -> np.ndarray:
        found = self.hash.lookup(keys)
        if not (self.pairs[found] == keys).all():
            raise ValueError("pairs that no chunk has sent")
        return found


def highest(table: DataFrame, size: int) -> np.ndarray:
    """The highest count of each B id; as many numbers as the vocabulary has entries."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(size, np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = (numbers(pairs) & np.uint64((1 << B_BITS) - 1)).astype(np.int64)
                np.maximum.at(most, ids, numbers(counts).astype(np.int64))
        at = np.flatnonzero(most)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(most[at])], names=["b", "most"])

    rows = table.select("pairs", "counts").mapInArrow(best, "b long, most long")
    found = np.zeros(size, np.int64)
    # at most one row per entry of the vocabulary
    for row in rows.groupBy("b").agg(F.max("most").alias("most")).collect():
        found[row["b"]] = row["most"]
    return found


def align(
    docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False, chunk_bytes: int = CHUNK_BYTES,
    block_bytes: int = BLOCK_BYTES, fan: int = FAN,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): a row per row of `docs` with its `COUNTS` and a digest of its groups, and the pairs by block.

    The groups are "a1,a2|b1;a3|b2,b3", ids in order, empty without tokens; `with_groups` adds them as a column. `pairs_of`
    unpacks the pairs. Both paths must be readable on every executor.
    """
    check(path_a, path_b)
    total = total_bytes(docs)
    chunks = max(1, math.ceil(total / chunk_bytes))
    size_a, size_b = len(bytes_a(path_a)), len(bytes_b(path_b))
    blocks = max(1, min(math.ceil(total / block_bytes), math.ceil(size_a * size_b / BLOCK_PAIRS)))
    chunked = in_chunks(docs, chunk_bytes, total)

    def send(rows: pa.Table) -> pa.Table:
        texts = split(documents(rows)[1])
        units = distinct_units(texts)
        tokens = tokens_of(units, path_a, path_b)
        parts, own = placed(texts, units, tokens, path_a, path_b)
        uses = np.zeros(len(own.units), np.int64)
        for p in parts:
            if p is not None:
                np.add.at(uses, p, 1)
        keys, counts = summed(own.pairs, np.repeat(uses, own.n_links))
        # units of texts without tokens do not count
        keys, counts = keys[counts > 0], counts[counts > 0]
        found = [(b, ascending(keys[i]), blob(counts[i])) for b, i in dealt(keys, blocks)]
        # the tokens travel beside the pairs, so that the second pass need not encode again
        found.append((TOKENS, tokens.packed(), b""))
        return pa.table(
            {
                "block": pa.array([f[0] for f in found], pa.int64()), "chunk": pa.array([rows["chunk"][0].as_py()] * len(found), pa.int64()),
                "pairs": pa.array([f[1] for f in found], pa.binary()), "counts": pa.array([f[2] for f in found], pa.binary()),
            }
        )

    sent = checkpointed(chunked.groupBy("chunk").applyInArrow(thrifty(send), "block long, chunk long, pairs binary, counts binary"))
    tokens = sent.filter(F.col("block") == TOKENS)
    sent = sent.filter(F.col("block") != TOKENS)
    table = checkpointed(pair_table(sent, chunks, fan))
    most = highest(table, size_b)

    def answer(rows: pa.Table, found: pa.Table) -> pa.Table:
        kind = "chunk long, block long, counts binary, best binary"
        if not rows.num_rows:
            return empty(kind)
        own = Table(found["hash"][0].as_py(), found["pairs"][0].as_py())
        counts = numbers(found["counts"][0].as_py()).astype(np.int64)
        best = counts == most[(own.pairs & np.uint64((1 << B_BITS) - 1)).astype(np.int64)]
        places = [own.places(ascended(p)) for p in rows["pairs"].to_pylist()]
        return pa.table(
            {
                "chunk": rows["chunk"], "block": rows["block"], "counts": pa.array([blob(counts[p]) for p in places], pa.binary()),
                "best": pa.array([np.packbits(best[p]).tobytes() for p in places], pa.binary()),
            }
        )

    grouped = sent.select("block", "chunk", "pairs", F.floor(F.col("chunk") / fan).cast("long").alias("grp"))
    sides = grouped.groupBy("block", "grp").cogroup(copies(table, max(1, -(-chunks // fan))).groupBy("block", "grp"))
    answers = sides.applyInArrow(thrifty(answer), "chunk long, block long, counts binary, best binary").union(
        tokens.select("chunk", "block", "pairs", "counts")
    )

    def place(rows: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = documents(rows)
        found = dict(zip(told["block"].to_pylist(), zip(told["counts"].to_pylist(), told["best"].to_pylist(), strict=True), strict=True))
        cut = split(texts)
        parts, own = placed(cut, distinct_units(cut), Tokens.unpacked(found[TOKENS][0]), path_a, path_b)
        used = np.zeros(len(own.units), bool)
        for p in parts:
            if p is not None:
                used[p] = True
        keys, at = np.unique(own.pairs[np.repeat(used, own.n_links)], return_inverse=True)
        counts, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for b, i in dealt(keys, blocks):
            counts[i] = numbers(found[b][0]).astype(np.int64)
            best[i] = np.unpackbits(np.frombuffer(found[b][1], np.uint8), count=len(i))
        # sums over the links of each unit, then over the units of each text
        owner = np.repeat(np.flatnonzero(used), own.n_links[used])
        sums = np.zeros((2, len(used)), np.int64)
        np.add.at(sums[0], owner, best[at])
        np.add.at(sums[1], owner, counts[at])
        of_unit = np.column_stack([own.n_a, own.n_b, own.n_groups, own.n_links, *sums])
        flat, sizes = group_texts(own)
        starts = np.cumsum(sizes) - sizes
        values, digests, groups = np.zeros((len(texts), len(COUNTS)), np.int64), [], []
        for i, p in enumerate(parts):
            told_groups = b""
            if p is not None:
                values[i] = of_unit[p].sum(0)
                told_groups = joined(flat, starts, sizes, p)[:-1].tobytes()
            digests.append(hashlib.sha256(told_groups).hexdigest() if told_groups else "")
            if with_groups:
                groups.append(told_groups)
        columns = dict(zip(COUNTS, (pa.array(v) for v in values.T.copy()), strict=True))
        shown = {"groups": pa.array(groups, pa.binary()).cast(pa.string())} if with_groups else {}
        return pa.table({"doc_id": ids, **columns, "groups_sha256": pa.array(digests, pa.string()), **shown})

    doc_id = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    result = T.StructType([doc_id, *(T.StructField(c, T.LongType()) for c in COUNTS)]).add("groups_sha256", "string")
    if with_groups:
        result = result.add("groups", "string")
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(thrifty(place), result), table


def pairs_of(table: DataFrame) -> DataFrame:
    """(a, b, n) of the counted pairs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = numbers(pairs)
                ids = keys >> np.uint64(B_BITS), keys & np.uint64((1 << B_BITS) - 1)
                yield pa.RecordBatch.from_arrays([*(pa.array(i.astype(np.int64)) for i in ids), pa.array(numbers(counts).astype(np.int64))], names=["a", "b", "n"])

    return table.select("pairs", "counts").mapInArrow(rows, "a long, b long, n long")
