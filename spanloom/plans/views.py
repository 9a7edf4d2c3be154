"""Derived relations the reports are built on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def span_key(ops: DataFrame, across_files: bool = False) -> list[Column]:
    """Columns that name a span: its id, and a hash of its file as well, so that spans of two files that happen
    to have one id stay apart. Spans that pass from file to file (``ingest`` with a ``stream_key`` and unique
    ids), and those of a table that does not name files, are named by the id alone."""
    own = F.col("span_id")
    return [own] if across_files or "file_name" not in ops.columns else [own, F.xxhash64("file_name").alias("_span_file")]


METRICS = ["cpu_time", "elapsed_time", "ph_reads", "cr_reads", "current_reads", "rows_processed"]


def span_elapsed(ops: DataFrame, remove_idle: bool = False, across_files: bool = False) -> DataFrame:
    """Elapsed microseconds per (sql_id, span): last minus first timed call of the span (see ``span_key``).

    ``client_id`` is that of the span's first line; when no one reads it, Catalyst prunes it and
    the aggregate is a plain hash aggregate over integers.
    """
    timed = ops.where(F.col("tim").isNotNull() & (F.col("tim") != 0))
    if remove_idle:
        timed = timed.where(F.col("cursor_id") != "#0")
    return _elapsed(timed, across_files).drop("_span_file")


def slow_spans(ops: DataFrame, slower_than: int, remove_idle: bool = False, across_files: bool = False) -> DataFrame:
    """The columns of ``span_key`` of spans above so many microseconds, each once."""
    timed = ops.where(F.col("tim").isNotNull() & (F.col("tim") != 0))
    if remove_idle:
        timed = timed.where(F.col("cursor_id") != "#0")
    slow = _elapsed(timed, across_files).where(F.col("ela") > slower_than)
    return slow.select("span_id", *[c for c in slow.columns if c == "_span_file"]).distinct()


def _elapsed(timed: DataFrame, across_files: bool) -> DataFrame:
    return timed.groupBy("sql_id", *span_key(timed, across_files)).agg(
        (F.max("tim") - F.min("tim")).alias("ela"),
        F.min("ts").alias("ts"),
        F.min_by("client_id", "line").alias("client_id"),
    )


def cursor_elapsed(ops: DataFrame, across_files: bool = False) -> DataFrame:
    """Elapsed microseconds per (cursor_id, span), for traces that lack statement ids."""
    return (
        ops.where(F.col("tim").isNotNull())
        .groupBy("cursor_id", *span_key(ops, across_files))
        .agg((F.max("tim") - F.min("tim")).alias("ela"), F.min("ts").alias("ts"))
        .drop("_span_file")
    )


def span_wall_elapsed(ops: DataFrame, across_files: bool = False) -> DataFrame:
    """Wall clock microseconds per (sql_id, span)."""
    length = F.expr("timestampdiff(MICROSECOND, min(ts), max(ts))")
    return (
        ops.where(F.col("ts").isNotNull())
        .groupBy("sql_id", *span_key(ops, across_files))
        .agg(length.alias("duration_us"))
        .drop("_span_file")
    )


def span_metrics(ops: DataFrame, across_files: bool = False) -> DataFrame:
    """Totals of the six call metrics per span."""
    return ops.groupBy(*span_key(ops, across_files)).agg(*[F.sum(m).alias(m) for m in METRICS]).drop("_span_file")


def sql_texts(ops: DataFrame, key: str, text: Column | None = None) -> DataFrame:
    """One statement text per ``key`` (sql_id or cursor_id): that of the lowest (file, line)."""
    shown = F.col("event_raw") if text is None else text
    parsed = ops.where(F.col("ops") == "PIC").select(key, "file_name", "line", shown.alias("_text"))
    return parsed.groupBy(key).agg(
        F.min_by("_text", F.struct("file_name", "line")).alias("sql_text")
    )
