"""Reading trace files as numbered lines."""

from __future__ import annotations

import lzma
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.sources.stage import stage

_PACKED = (".xz", ".lzma")
INDEX_ROWS = 1 << 20  # splits whose index is sent to the executors: 24 bytes each
_LINES = "file_name string, line bigint, value string"


def read_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``file_name, line, value`` of trace files, folders or globs; lines count from 1 per file.

    Plain text is split, gzip and bzip2 are recognised by their extension. Paths that end in
    ``.xz`` or ``.lzma`` take a separate reader; such a file inside a folder or glob is an error, since it
    would be read as text. Bytes that are no UTF-8 become replacement characters in all of them.
    """
    every = [paths] if isinstance(paths, str) else list(paths)
    packed = [p for p in every if p.endswith(_PACKED)]
    plain = [p for p in every if not p.endswith(_PACKED)]
    if not every:
        raise ValueError("no input paths")
    parts = []
    if plain:
        text = spark.read.text(plain).select(
            F.col("_metadata.file_path").alias("file_name"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_at"),
            _readable("value").alias("value"),
        )
        parts.append(number_lines(text))
    if packed:
        parts.append(_unpacked(spark, packed))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _readable(value: str) -> Column:
    path = F.col("_metadata.file_path")
    named = F.concat(F.lit("name packed files themselves: "), path)
    return F.when(path.rlike(r"\.(xz|lzma)$"), F.raise_error(named)).otherwise(F.col(value))


def number_lines(raw: DataFrame) -> DataFrame:
    """Line numbers without moving the text: ``raw`` has ``file_name, _split, _at, value``.

    The lines of one input split are consecutive in one task, so their distance ``_at`` to the first
    one is known there; the number of lines in earlier splits of the file comes from an index of one row per
    split, which goes to the executors. With more than ``INDEX_ROWS`` splits the files are taken in as many parts
    as it needs, each with an index of its own.
    """
    index = _split_index(raw)
    parts = -(-index.count() // INDEX_ROWS)
    if parts <= 1:
        return _with_lines(raw, index)
    numbered = []
    for part in range(parts):
        some = raw.where(f"pmod(xxhash64(file_name), {parts}) = {part}")
        numbered.append(_with_lines(some, _split_index(some)))  # its own: other splits share tasks in this scan
    out = numbered[0]
    for df in numbered[1:]:
        out = out.unionByName(df)
    return out


def _split_index(raw: DataFrame) -> DataFrame:
    """``file_name, _split, _shift``: what makes a line number of ``_at`` in that split."""
    earlier = (
        Window.partitionBy("file_name")
        .orderBy("_split")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = raw.groupBy("file_name", "_split").agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return stage(splits.select("file_name", "_split", (before - F.col("_from") + 1).alias("_shift")), "splits")


def _with_lines(raw: DataFrame, index: DataFrame) -> DataFrame:
    """Files go by a hash of their name, eight bytes instead of a path, if it tells them apart."""
    code = F.xxhash64("file_name").alias("_code")
    rows, different = index.agg(F.count("*"), F.count_distinct(code, "_split")).first()
    named = [code] if rows == different else [F.col("file_name").alias("_code")]
    found = index.select(*named, "_split", "_shift")
    # A part whose one file has more splits than an index may hold is joined like any two tables.
    found = F.broadcast(found) if rows <= 2 * INDEX_ROWS else found
    # Outer: a plan that asks for no line may cut the files into other splits and still loses no row.
    coded = raw.select("*", *named).join(found, ["_code", "_split"], "left")
    return coded.select("file_name", (F.col("_at") + F.col("_shift")).alias("line"), "value")


def _unpacked(spark: SparkSession, paths: list[str]) -> DataFrame:
    """xz and lzma have no splittable codec: one task per file decodes and numbers, batch by batch."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _decoded(path, content)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(lines, _LINES)


def _decoded(path: str, content: bytes, step: int = 1 << 20) -> Iterator[pd.DataFrame]:
    decoder = lzma.LZMADecompressor()
    rest, done = b"", 0
    for start in range(0, len(content), step):
        chunk = content[start : start + step]
        while chunk:
            if decoder.eof:  # concatenated streams
                decoder = lzma.LZMADecompressor()
            rest += decoder.decompress(chunk)
            chunk = decoder.unused_data if decoder.eof else b""
        *full, rest = rest.split(b"\n")
        if full:
            yield _frame(path, full, done)
            done += len(full)
    if rest:
        yield _frame(path, [rest], done)


def _frame(path: str, lines: list[bytes], done: int) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "file_name": path,
            "line": range(done + 1, done + len(lines) + 1),
            "value": [line.rstrip(b"\r").decode("utf-8", "replace") for line in lines],
        }
    )
