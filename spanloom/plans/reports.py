"""The latency reports. Every function takes the fact table and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.filters import semi_join
from spanloom.functions.labels import short_path, statement_label, wait_label
from spanloom.functions.predicates import threshold
from spanloom.functions.quantiles import grouped_stats
from spanloom.plans.views import METRICS, cursor_elapsed, slow_spans, span_elapsed, span_key, span_metrics, sql_texts
from spanloom.sources.stage import stage

DEFAULT_LIMIT = 30


def _where(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def _top(groups: DataFrame, metric: str, keys: list[str], limit: int | None) -> DataFrame:
    """The ``limit`` largest groups, or all of them, with ``rownum``, their ascending rank among all groups.

    Ties go by key. The groups are a table first, for they are read more than once. Ranking them in one
    window takes a sort in one task: instead, the rank of the k-th largest is the number of groups minus
    k - 1, so only ``limit`` rows are numbered; without a limit the groups are range-sorted and numbered
    by range, from the counts of the ranges before.
    """
    groups = stage(groups, "groups")
    order = [F.col(metric).desc(), *[F.col(k).asc_nulls_first() for k in keys]]
    total = groups.agg(F.count("*").alias("groups"))
    if limit is not None:
        place = F.row_number().over(Window.orderBy(*order))
        return groups.orderBy(*order).limit(limit).withColumn("rownum", total.scalar() + F.lit(1) - place)
    ranges = stage(groups.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranges.join(starts, "_range").withColumn("rownum", total.scalar() + F.lit(1) - place)
    return numbered.drop("_range", "_start")


def summary(
    ops: DataFrame,
    where: Column | None = None,
    limit: int | None = DEFAULT_LIMIT,
    remove_idle: bool = False,
    across_files: bool = False,
    executions: DataFrame | None = None,
) -> DataFrame:
    """Executions and latency per statement; ``where`` filters executions (see ``preds``).

    ``executions`` are the rows to take executions from where ``where`` makes do with fewer than ``ops``
    (see ``read_clustered``); statement texts come from ``ops``.
    """
    rows = ops if executions is None else executions
    spans = stage(_where(span_elapsed(rows, remove_idle, across_files), where).select("sql_id", "ela"), "spans")
    stats = grouped_stats(spans, ["sql_id"], "ela")
    top = _top(stats, "n", ["sql_id"], limit)
    texts = sql_texts(ops, "sql_id", statement_label(F.col("event_raw")))
    return (
        top.join(texts, "sql_id", "left")
        .select(
            "rownum",
            F.coalesce("sql_id", F.lit("NULL")).alias("sql_id"),
            F.coalesce("sql_text", F.lit("NULL")).alias("sql_text"),
            F.col("n").alias("executions"),
            F.col("total").alias("total_us"),
            F.col("median").alias("median_us"),
            F.col("p99").alias("p99_us"),
            F.col("max").alias("max_us"),
        )
        .orderBy(F.desc("rownum"))
    )


def cursor_summary(ops: DataFrame, across_files: bool = False) -> DataFrame:
    """Executions and latency per cursor handle, for traces that miss the parse records."""
    spans = stage(cursor_elapsed(ops, across_files).select("cursor_id", "ela"), "cursors")
    stats = grouped_stats(spans, ["cursor_id"], "ela")
    return (
        stats.join(sql_texts(ops, "cursor_id"), "cursor_id", "left")
        .select("cursor_id", "sql_text", F.col("n").alias("execs"), "median", "p99")
        .orderBy("execs", "cursor_id")
    )


def outliers(
    ops: DataFrame,
    limits: str | int | list[int] | None = None,
    where: Column | None = None,
    statistic: str = "elapsed_time",
    limit: int | None = DEFAULT_LIMIT,
    across_files: bool = False,
) -> DataFrame:
    """Executions by the total of ``statistic`` (any numeric column), largest first.

    ``limits`` is as in ``threshold``; without it, executions with a zero or NULL total go. The
    place of the first line is looked up afterwards, for the shown executions only, so the big
    aggregate carries integers alone.
    """
    named = span_key(ops, across_files)
    rows = _where(ops, where).select("*", *named[1:])
    keys = ["cursor_id", "span_id", *(["_span_file"] if named[1:] else [])]
    total = F.col("_total")
    condition = threshold(limits, total)
    groups = (
        rows.groupBy(*keys)
        .agg(F.sum(statistic).alias("_total"), F.min("line").alias("_line"))
        .where(total != 0 if condition is None else condition)
    )
    top = _top(groups, "_total", [*keys, "_line"], limit)
    here = [F.col(f"h.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    same = F.col("h.line") == F.col("t._line")
    for condition in here:
        same = same & condition
    found = rows.alias("h").join(top.alias("t"), same)
    return (
        found.groupBy("t.rownum", "t.cursor_id", "t._total", "t._line")
        .agg(F.min(F.struct("h.file_name", "h.ts")).alias("_at"))
        .select(
            "rownum",
            F.col("cursor_id").alias("cursor"),
            total.alias(statistic),
            F.col("_at.ts").alias("ts"),
            short_path(F.col("_at.file_name"), 36).alias("file_name"),
            F.col("_at.file_name").alias("file_path"),
            F.col("_line").alias("first_line"),
        )
        .orderBy(F.desc("rownum"))
    )


def waits(
    ops: DataFrame,
    where: Column | None = None,
    slower_than: int | None = None,
    limit: int | None = DEFAULT_LIMIT,
    remove_idle: bool = False,
    across_files: bool = False,
) -> DataFrame:
    """Wait events; ``slower_than`` keeps only waits inside executions above that many µs. A filter of these
    executions keeps nearly all other waits from being shuffled."""
    rows = _where(ops.where(F.col("ops") == "WAIT"), where)
    if slower_than is not None:
        slow = stage(slow_spans(ops, slower_than, remove_idle, across_files), "slow_spans")
        inside = rows.where(F.col("cursor_id") != "#0").select("event_name", "cursor_id", "elapsed_time", *span_key(ops, across_files))
        rows = semi_join(inside, slow, slow.columns)
    named = rows.select(
        wait_label(F.col("event_name"), F.col("cursor_id")).alias("wait"), "elapsed_time"
    )
    stats = grouped_stats(stage(named, "waits"), ["wait"], "elapsed_time")
    top = _top(stats, "n", ["wait"], limit)
    return top.select(
        "rownum",
        "wait",
        F.col("n").alias("count"),
        F.col("total").alias("sum_us"),
        F.col("median").alias("median_us"),
        F.col("p99").alias("p99_us"),
        F.col("max").alias("max_us"),
    ).orderBy(F.desc("rownum"))


def db_totals(ops: DataFrame) -> DataFrame:
    """Rows, files, statements, cursors and time range of the whole table, from one scan: rows are combined by file,
    statement and cursor, and the distinct counts read what is left."""
    keys = ["file_name", "sql_id", "cursor_id"]
    groups = ops.groupBy(*keys).agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        *[F.count_distinct(k).alias(name) for k, name in zip(keys, ("files", "sql_ids", "cursors"), strict=True)],
        F.min("first").alias("first_timestamp"),
        F.max("last").alias("last_timestamp"),
    )


def db_files(ops: DataFrame, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """Rows and time range per trace file, largest files first."""
    groups = ops.groupBy("file_name").agg(
        F.count("*").alias("rows"),
        F.min("ts").alias("_first"),
        F.max("ts").alias("_last"),
        (F.max("tim") - F.min("tim")).alias("_tim"),
    )
    first, last = (F.date_trunc("second", F.col(c)) for c in ("_first", "_last"))
    return (
        _top(groups, "rows", ["file_name"], limit)
        .select(
            "rownum",
            short_path(F.col("file_name"), 21).alias("file_name"),
            F.col("file_name").alias("file_path"),
            "rows",
            first.cast("timestamp_ntz").alias("first_timestamp"),
            last.cast("timestamp_ntz").alias("last_timestamp"),
            F.timestamp_diff("SECOND", first, last).alias("wallclock_s"),
            F.round(F.col("_tim") / F.lit(1e6)).cast("int").alias("elapsed_s"),
        )
        .orderBy(F.desc("rownum"))
    )


# Names the metrics have in the report.
_METRIC_NAMES = {
    "cpu_time": "cpu",
    "elapsed_time": "elapsed",
    "ph_reads": "physical_reads",
    "cr_reads": "consistent_reads",
    "current_reads": "current_reads",
    "rows_processed": "rows_processed",
}


def sql_metrics(ops: DataFrame, sql_id: str, across_files: bool = False) -> DataFrame:
    """Distribution of six per-execution totals of one statement, from a single scan."""
    spans = span_metrics(ops.where(F.col("sql_id") == sql_id), across_files)
    renamed = spans.select("span_id", *[F.col(m).alias(_METRIC_NAMES[m]) for m in METRICS])
    wide = stage(renamed, "metrics")
    long = wide.unpivot("span_id", list(_METRIC_NAMES.values()), "statistic", "value")
    return grouped_stats(long, ["statistic"], "value").select(
        "statistic", F.col("total").alias("sum"), "median", "p99", "max"
    )


# The operations shown and their order in the report.
_SHOWN_OPS = ["PIC", "PARSE", "EXEC", "WAIT", "FETCH", "CLOSE", "ERROR"]


def shown_op(ops: Column) -> Column:
    """Operation name as users know it."""
    return F.when(ops == "PIC", F.lit("PARSING IN CURSOR")).otherwise(ops)


def sql_ops(ops: DataFrame, sql_id: str) -> DataFrame:
    """CPU and elapsed time of one statement by operation."""
    rows = ops.where((F.col("sql_id") == sql_id) & F.col("ops").isin(_SHOWN_OPS))
    timed = stage(rows.select("ops", "cpu_time", "elapsed_time"), "timed_calls")
    long = timed.unpivot("ops", ["cpu_time", "elapsed_time"], "_measure", "_value")
    stats = grouped_stats(long, ["ops", "_measure"], "_value")

    def of(measure: str, stat: str) -> Column:
        return F.max(F.when(F.col("_measure") == measure, F.col(stat)))

    wide = stats.groupBy("ops").agg(
        of("cpu_time", "n").alias("count"),
        *[
            of(measure, stat).alias(f"{name}_{short}")
            for measure, short in (("cpu_time", "cpu"), ("elapsed_time", "elapsed"))
            for name, stat in (("sum", "total"), ("median", "median"), ("p99", "p99"), ("max", "max"))
        ],
    )
    rank = F.array_position(F.lit(["PIC", "PARSE", "EXEC", "WAIT", "FETCH"]), F.col("ops"))
    return wide.orderBy(F.when(rank == 0, 6).otherwise(rank), "ops").select(
        shown_op(F.col("ops")).alias("operation"), *[c for c in wide.columns if c != "ops"]
    )
