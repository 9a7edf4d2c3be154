"""Reading and writing the fact table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.predicates import id_list

from spanloom.schema import OPS_COLUMNS, OPS_SCHEMA, SCHEMA_VERSION, conform

# Columns with another name in the relational table.
RELATIONAL_NAMES = {"event_name": "wait_name", "event_raw": "wait_raw", "uid": "pic_uid"}


def read_ops(spark: SparkSession, path: str) -> DataFrame:
    """Fact table from Parquet files of this library or with unsigned column types."""
    return conform(spark.read.parquet(path))


def _with_version(ops: DataFrame) -> DataFrame:
    """The rows and one more that states the version of the layout."""
    version = ops.sparkSession.range(1).select(
        F.lit("HEADER").alias("ops"),
        F.lit("PARQUET_SCHEMA").alias("event_name"),
        F.lit(SCHEMA_VERSION).alias("event_raw"),
    )
    return conform(ops).unionByName(conform(version))


def write_ops(
    ops: DataFrame,
    path: str,
    mode: str = "append",
    compression: str = "gzip",
    rows_per_file: int = 0,
    version_row: bool = True,
) -> None:
    """Write the fact table as Parquet; the scheme of ``path`` picks the file system.

    ``rows_per_file`` rolls files by size; 0 leaves one file per task. The version row is written
    once per call, not once per file.
    """
    rows = _with_version(ops) if version_row else conform(ops)
    (
        rows.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


# Columns of a clustered table besides the fact table's: when the row's span begins and ends, and the day of both.
_SPAN_TIMES = "span_first timestamp_ntz, span_last timestamp_ntz, span_day date"
MANY_DAYS = "0001-01-01"


def write_clustered(
    ops: DataFrame,
    path: str,
    mode: str = "append",
    compression: str = "gzip",
    files: int | None = None,
    row_group_bytes: int = 32 << 20,
    across_files: bool = False,
    version_row: bool = True,
) -> None:
    """Write the fact table so that filters by time and statement read a part of it: see ``read_clustered``.

    All rows of a span go into the folder of its day (``span_day``; one more holds spans of several days and one
    those without a wall clock). Rows are dealt out by sampled bounds of day, statement and time, down to the
    line, so that a hot statement is cut as well, and every file is sorted by them: a row group holds
    few statements and a short time, and its statistics, and a Bloom filter of statement ids, say which. There are as many
    tasks as ``files`` or shuffle partitions. ``across_files`` is as in ``span_key``.
    """
    rows = _with_version(ops) if version_row else conform(ops)
    file = "'' as _span_file" if across_files else "xxhash64(file_name) as _span_file"
    named = rows.selectExpr("*", "span_id as _span", file)
    spans = named.where("span_id is not null").groupBy("_span", "_span_file").agg(
        F.min("ts").alias("span_first"), F.max("ts").alias("span_last")
    )
    day = f"if(cast(span_first as date) = cast(span_last as date), cast(span_first as date), date'{MANY_DAYS}') as span_day"
    timed = named.join(spans, ["_span", "_span_file"], "left").selectExpr(*OPS_COLUMNS, "span_first", "span_last", day)
    order = ["span_day", "sql_id", "span_first", "file_name", "line"]
    dealt = timed.repartitionByRange(files, *order) if files else timed.repartitionByRange(*order)
    (
        dealt.sortWithinPartitions(*order)
        .write.mode(mode)
        .option("compression", compression)
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#sql_id", "true")
        .partitionBy("span_day")
        .parquet(path)
    )


def read_clustered(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    sql_ids: str | Iterable[str] | None = None,
) -> DataFrame:
    """The rows of a clustered table that reports on executions need under the same ``preds``: whole spans that
    have a part in the time from ``start`` to before ``end``, of the given statements.

    Days, row groups and pages that can hold none of them are not read.
    """
    rows = spark.read.schema(f"{OPS_SCHEMA.toDDL()}, {_SPAN_TIMES}").parquet(path)
    for limit, shown, column in ((start, "span_day >= cast({} as date)", "span_last >= {}"), (end, "span_day <= cast({} as date)", "span_first < {}")):
        if limit is not None:
            stamp = f"cast({_quoted(limit)} as timestamp_ntz)"
            rows = rows.where(f"{shown.format(stamp)} or span_day = date'{MANY_DAYS}'").where(column.format(stamp))
    if sql_ids is not None:
        rows = rows.where(F.col("sql_id").isin(id_list(sql_ids)))
    return conform(rows)


def _quoted(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def jdbc_rows(ops: DataFrame, raw_length: int | None = None) -> DataFrame:
    """The fact table with the relational column names; raw text is cut only if the table holds no more
    than ``raw_length`` characters of it."""
    rows = conform(ops)
    if raw_length is not None:
        rows = rows.withColumn("event_raw", F.substring("event_raw", 1, raw_length))
    return rows.withColumnsRenamed(RELATIONAL_NAMES).select(
        *[RELATIONAL_NAMES.get(c, c) for c in OPS_COLUMNS]
    )


def write_jdbc(
    ops: DataFrame,
    url: str,
    table: str = "dbcall",
    mode: str = "append",
    raw_length: int | None = None,
    **properties: str,
) -> None:
    """Insert into a relational table in batches of 1000 rows per connection."""
    jdbc_rows(ops, raw_length).write.option("batchsize", 1000).jdbc(url, table, mode, properties)
