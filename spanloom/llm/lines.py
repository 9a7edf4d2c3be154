"""Lines that several documents repeat: two Bloom filters, then an exact count of the suspects.

Each task keeps the hashes of its documents' lines once. Lines seen go to a first filter, lines seen in
two documents to a second one; filters of two tasks are joined as ``once | once`` and
``twice | twice | once & once``. Filters are dealt out in slices, so no task holds all tasks' filters.
The merged second filter is sent to the executors. Only lines that it knows are shuffled: they are
counted exactly, and the documents that lose lines learn which.

The filter has about eight bits a line, up to a fixed size. With more lines than that more lines are
suspected, which costs shuffling but changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.rows import flat_map, map_rows, others
from spanloom.llm.sketch import bloom, contains, slices_for
from spanloom.sources.stage import stage

_SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def line_keys(text: str | None, shortest: int) -> list[bytes]:
    """Key of each line; empty for lines whose key has fewer than ``shortest`` code points."""
    keys = [line.strip(_SPACE) for line in (text or "").encode().translate(_LOWER).split(b"\n")]
    return [k if len(k) >= 4 * shortest or len(k) >= shortest and len(k.decode()) >= shortest else b"" for k in keys]


def repeated_lines(
    docs: DataFrame, least: int = 3, shortest: int = 20, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(suspects, repeats)``: a row per (``_key``, ``_hash`` of the text, ``_line``) whose line the filter knows,
    and a row per ``_line`` found in at least ``least`` documents with its largest key ``_keeper``. Lines are 128-bit hashes."""
    spark = docs.sparkSession
    size = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    lines = docs.agg(F.sum(size)).first()[0] or 0

    def hashes():
        def some(part: pa.RecordBatch):
            keys = [k for value in part.column(0).to_pylist() for k in set(line_keys(value, shortest)) if k]
            return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))

        return some

    known = spark.sparkContext.broadcast(bloom(docs.select(text), hashes, slices_for(lines), twice=True))

    def suspect():
        planes = known.value

        def some(part: pa.RecordBatch):
            owners, keys, hashes = [], [], []
            for i, value in enumerate(part.column(1).to_pylist()):
                own = list(dict.fromkeys(k for k in line_keys(value, shortest) if k))
                keys += own
                owners += [i] * len(own)
                hashes += [xxhash.xxh3_64_intdigest(k) for k in own]
            if not keys:
                return None
            found = np.flatnonzero(contains(planes, np.array(hashes, np.uint64))).tolist()
            names, texts = part.column(0).to_pylist(), part.column(2).to_pylist()
            return [names[owners[i]] for i in found], [texts[owners[i]] for i in found], [xxhash.xxh3_128_digest(keys[i]) for i in found]

        return some

    kind = docs.schema[key].dataType.simpleString()
    suspects = stage(flat_map(docs.select(key, text, F.xxhash64(text)), suspect, f"_key {kind}, _hash long, _line binary"), "suspected_lines")
    repeats = stage(
        suspects.groupBy("_line", "_key")
        .agg(F.lit(1).alias("_one"))
        .groupBy("_line")
        .agg(F.count("_key").alias("_documents"), F.max("_key").alias("_keeper"))
        .where(F.col("_documents") >= least),
        "repeated_lines",
    )
    return suspects, repeats


def dedup_lines(
    docs: DataFrame, least: int = 3, shortest: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_lines`` (before), ``n_dropped``, ``kept`` (the text of the lines
    that stay) and ``row``, a struct of all other columns but the text.

    A line's key has white space stripped at both ends and A-Z lower-cased. Keys of ``shortest`` code
    points and more, found in ``least`` documents or more, lose all their lines except in the document
    of the largest key. A document is a key; rows that repeat one decide as one. A row with a null key
    counts as no document and keeps no repeated line. A null or empty text is one empty line.

    Rows learn their own lines alone, by key and hash of the text, so the rows of one key are no group.
    """
    suspects, repeats = repeated_lines(docs, least, shortest, key, text)
    drops = (
        suspects.join(repeats.select("_line", "_keeper"), "_line")
        .where(~F.col("_key").eqNullSafe(F.col("_keeper")))
        .groupBy("_key", "_hash")
        .agg(F.collect_set("_line").alias("_drop"))
    )

    def keep():
        def one(value, drop):
            lines = (value or "").split("\n")
            if not drop:
                return len(lines), 0, value or ""
            gone = set(drop)
            keys = line_keys(value, shortest)
            kept = [line for line, k in zip(lines, keys, strict=True) if not k or xxhash.xxh3_128_digest(k) not in gone]
            return len(lines), len(lines) - len(kept), "\n".join(kept)

        return one

    slim = docs.select(F.col(key).alias("_own"), F.col(text).alias("_text"), F.xxhash64(text).alias("_of"), others(docs, key, text).alias("row"))
    same = F.col("_own").eqNullSafe(F.col("_key")) & (F.col("_of") == F.col("_hash"))
    joined = slim.join(drops, same, "left").drop("_key", "_hash", "_of")
    rows = map_rows(joined, keep, ["_text", "_drop"], "n_lines long, n_dropped long, kept string")
    return rows.select(F.col("_own").alias(key), "n_lines", "n_dropped", "kept", "row")
