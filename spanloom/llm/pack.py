"""Packing along a Hilbert curve: documents of like words share sequences, and no sequence has gaps.

A document's distinct tokens, hashed to random directions, give a point in a few dimensions. Rows are
range-sorted by the place of their point on a Hilbert curve (rows of one place by their number, so that
many copies still split over tasks), and their tokens laid end to end; every ``size`` tokens a sequence
ends. What is left at the end goes to sequences of descending powers of two, which need no padding.

Texts are tokenized once, into a staged table. Sorting and the running sums move a few numbers per
document, and one join brings each document's place to its tokens.
"""

from __future__ import annotations

import base64
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm.rows import flat_map
from spanloom.sources.stage import stage

DIMENSIONS = 3
BITS = 16


class ByteCoder:
    """Byte-level BPE as the tokenizer file does it, by a faster library that has the same vocabulary as
    ranks. Texts that hold special tokens go to the tokenizer itself."""

    def __init__(self, path: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text)
            except ValueError:  # its pattern engine gives up on very long runs
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_CODERS: dict[tuple, ByteCoder] = {}


def _coder(*where: str) -> ByteCoder:
    if where not in _CODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _CODERS[where] = ByteCoder(*where)
    return _CODERS[where]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of ``points`` (rows of integers below ``2**bits``), as 64-bit integers."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:  # undo rotations and reflections, from the coarsest cell on
        low = level - 1
        for i in range(dims):
            high = (x[i] & level) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] ^= np.where(high, low, swap)
            x[i] ^= np.where(high, 0, swap)
        level >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[dims - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


_DIRECTIONS: dict[int, np.ndarray] = {}


def curve_places(documents: list[np.ndarray], vocabulary: int = 1 << 16, seed: int = 11) -> list[int]:
    """Hilbert places of documents: their distinct ids as points, squeezed into the unit cube."""
    if seed not in _DIRECTIONS:
        _DIRECTIONS[seed] = np.random.default_rng(seed).standard_normal((vocabulary, DIMENSIONS)).astype(np.float32)
    own = [np.unique(ids) for ids in documents]
    points = np.array([_DIRECTIONS[seed][ids].sum(axis=0) / max(1.0, len(ids)) ** 0.5 for ids in own]).reshape(-1, DIMENSIONS)
    return hilbert((1 / (1 + np.exp(-1.7 * points)) * ((1 << BITS) - 1)).astype(np.int64)).tolist()


def sequence_of(place: int, total: int, size: int) -> tuple[int, int, int]:
    """Sequence, offset and remaining room of a token's place among ``total`` tokens."""
    full, rest = divmod(total, size)
    if place < full * size:
        return place // size, place % size, size - place % size
    at, sequence, left = place - full * size, full, rest
    while True:  # the rest, in descending powers of two
        length = 1 << (left.bit_length() - 1)
        if at < length:
            return sequence, at, length - at
        at, left, sequence = at - length, left - length, sequence + 1


def pack(
    docs: DataFrame,
    tokenizer: tuple[str, str, str],
    size: int = 2048,
    end: int = 1,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of a document: key, ``start``, ``length``, ``ids`` (binary, little-endian 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer``: tokenizer file, ranks file, pattern. ``end`` follows the ids of every document, so a
    null or empty text has one piece of one id. Documents are cut freely, each id is in exactly one
    piece, sequences are full but for the last few, whose lengths are powers of two. Null and repeated
    keys are documents like others; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    last = np.uint32(end)

    def tokenize():
        own = _coder(*tokenizer)

        def some(part: pa.RecordBatch):
            coded = [np.append(own.encode(value or ""), last).astype("<u2") for value in part.column(1).to_pylist()]
            return part.column(0).to_pylist(), [c.tobytes() for c in coded], list(map(len, coded)), curve_places(coded)

        return some

    kind = docs.schema[key].dataType.simpleString()
    tokens = flat_map(docs.select(key, text), tokenize, f"_key {kind}, _ids binary, _n long, _place long")
    tokens = stage(tokens.withColumn("_row", F.monotonically_increasing_id()), "pack_tokens", compression="zstd")
    ordered = stage(
        tokens.select("_row", "_n", "_place")
        .repartitionByRange("_place", "_row")
        .sortWithinPartitions("_place", "_row")
        .withColumn("_part", F.spark_partition_id()),
        "pack_order",
    )
    parts = ordered.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    base = parts.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_part").orderBy("_place", "_row").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        ordered.withColumn("_at", F.sum("_n").over(own) - F.col("_n"))
        .join(base, "_part")
        .select("_row", (F.col("_base") + F.col("_at")).alias("_first"))
    )
    total = ordered.agg(F.sum("_n")).first()[0] or 0

    def cut():
        def some(part: pa.RecordBatch):
            out = [[] for _ in range(7)]
            for doc, coded, first in zip(*(part.column(c).to_pylist() for c in ("_key", "_ids", "_first")), strict=True):
                ids = np.frombuffer(coded, "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    sequence, offset, room = sequence_of(first + at, total, size)
                    piece = ids[at : at + room]
                    for column, value in zip(out, (doc, at, len(piece), piece.tobytes(), len(ids), sequence, offset), strict=True):
                        column.append(value)
                    at += len(piece)
            return out

        return some

    rows = tokens.select("_row", "_key", "_ids").join(places, "_row").select("_key", "_ids", "_first")
    return flat_map(
        rows, cut, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
