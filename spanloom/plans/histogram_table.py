"""A stored histogram of latencies by hour, kept up to date by batches.

Bucket counts of executions per statement, and of waits per event, add up: a table of counts per hour takes every
batch of new rows once, and the histogram of any range of hours is the sum of its counts, equal to the one made from
all rows. A batch has a folder of its own, so one that is tried again replaces what it left. Compaction writes the
sum of some batches as one more and then, in a single row, what it stands for; readers leave out batches that a
stated sum holds, and sums that are not stated.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spanloom.functions.predicates import id_list
from spanloom.plans.histogram import hdr_histogram
from spanloom.plans.views import span_elapsed
from spanloom.schema import TRACKED_OPS

_KEYS = ["kind", "name", "hour", "value_low", "value_high"]
_COUNTS = "kind string, name string, hour timestamp_ntz, value_low bigint, value_high bigint, count bigint, batch string"
_SUMS = "total string, batches array<string>"
KINDS = ("sql", "wait")


def hourly_counts(ops: DataFrame, remove_idle: bool = False, across_files: bool = False) -> DataFrame:
    """``kind, name, hour, value_low, value_high, count``: executions by statement (``sql``) in the hour they began, and
    waits by event (``wait``) in the hour of their record. Rows without a wall clock are in no hour."""
    spans = span_elapsed(ops.where(F.col("ops").isin(TRACKED_OPS)), remove_idle, across_files)
    waits = ops.where(F.col("ops") == "WAIT")
    rows = spans.selectExpr("'sql' as kind", "sql_id as name", "ts", "ela as value").unionByName(
        waits.selectExpr("'wait' as kind", "event_name as name", "ts", "elapsed_time as value")
    )
    timed = rows.where("ts is not null").selectExpr("kind", "name", "cast(date_trunc('HOUR', ts) as timestamp_ntz) as hour", "value")
    return hdr_histogram(timed, ["kind", "name", "hour"], "value")


def add_batch(ops: DataFrame, path: str, batch: str, remove_idle: bool = False, across_files: bool = False) -> None:
    """Add the rows of one batch, whole spans, under its name."""
    if batch.startswith("total-"):
        raise ValueError("names that begin with 'total-' are those of compactions")
    _write(hourly_counts(ops, remove_idle, across_files), path, batch)


def _write(counts: DataFrame, path: str, batch: str) -> None:
    sorted_ = counts.repartitionByRange("kind", "name", "hour").sortWithinPartitions("kind", "name", "hour")
    sorted_.write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")


def _sums(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_SUMS).parquet(f"{path}/sums")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SUMS)


def _counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts of the batches and sums that are to be read."""
    sums = _sums(spark, path)
    held = sums.select(F.explode("batches").alias("batch"))
    every = spark.read.schema(_COUNTS).parquet(f"{path}/counts")
    stated = every.where("not startswith(batch, 'total-')").unionByName(
        every.where("startswith(batch, 'total-')").join(sums.select(F.col("total").alias("batch")), "batch", "left_semi")
    )
    return stated.join(held, "batch", "left_anti")


def compact(spark: SparkSession, path: str) -> str:
    """Sum all batches into one; the name of the sum. One writer at a time."""
    counts = _counts(spark, path)
    batches = [r[0] for r in counts.select("batch").distinct().collect()]  # names of folders
    total = f"total-{uuid.uuid4().hex}"
    _write(counts.groupBy(*_KEYS).agg(F.sum("count").alias("count")), path, total)
    spark.createDataFrame([(total, batches)], _SUMS).coalesce(1).write.mode("append").parquet(f"{path}/sums")
    return total


def hours_histogram(
    spark: SparkSession,
    path: str,
    kind: str,
    start: str | None = None,
    end: str | None = None,
    names: str | Iterable[str] | None = None,
) -> DataFrame:
    """``name, value_low, value_high, count`` over the hours from ``start`` to before ``end``, both on the hour."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    rows = _counts(spark, path).where(F.col("kind") == kind)
    if names is not None:
        rows = rows.where(F.col("name").isin(id_list(names)))
    for limit, condition in ((start, F.col("hour").__ge__), (end, F.col("hour").__lt__)):
        if limit is not None:
            stamp = F.to_timestamp_ntz(F.lit(limit))
            whole = F.date_trunc("HOUR", stamp) == stamp
            rows = rows.where(F.when(whole, condition(stamp)).otherwise(F.raise_error(F.lit(f"not on the hour: {limit}"))))
    return rows.groupBy("name", "value_low", "value_high").agg(F.sum("count").alias("count"))
