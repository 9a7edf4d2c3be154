"""Client interactions as spans and their events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.plans.reports import shown_op

# Names users give for the trace id, and the columns behind them.
TRACE_ID_COLUMNS = {"CLIENT ID": "client_id", "MODULE": "module", "ACTION": "action"}


def export_spans(ops: DataFrame, trace_id_col: str = "CLIENT ID", across_files: bool = False) -> DataFrame:
    """One row per span: ``span_id, file_name, trace_id, name, start_ns, end_ns, first_line, n_events``.

    The trace id is the named session attribute of the span's first record (a column name also
    does). Wall clock and header records are left out. The span's events are the rows of
    ``export_events`` with its ``span_id`` and file, in order of their lines: a span of any length has this one
    shape, and nothing is collected. Spans that go ``across_files`` are named by their id alone, ordered by
    time first, and have the file of their first record.
    """
    events = export_events(ops, trace_id_col)
    order = "time_ns, file_name, line" if across_files else "line"
    file = F.col("attributes.file_name") if "file_name" in ops.columns else F.lit(None).cast("string")
    return events.select("*", file.alias("file_name")).groupBy(
        "span_id", *([] if across_files else ["file_name"])
    ).agg(
        F.expr(f"min_by(struct(trace_id, sql_id, time_ns, line{', file_name' if across_files else ''}), struct({order})) as _first"),
        F.expr(f"max_by(time_ns, struct({order})) as _last"),
        F.expr("count(*) as n_events"),
    ).selectExpr(
        "span_id",
        "_first.file_name as file_name" if across_files else "file_name",
        "_first.trace_id as trace_id",
        "_first.sql_id as name",
        "_first.time_ns as start_ns",
        "_last as end_ns",
        "_first.line as first_line",
        "n_events",
    )


def export_events(ops: DataFrame, trace_id_col: str = "CLIENT ID") -> DataFrame:
    """The events of all spans, one row each: ``span_id, trace_id, sql_id, line, time_ns, name, attributes``."""
    column = TRACE_ID_COLUMNS.get(trace_id_col, trace_id_col)
    if column not in ops.columns:
        raise ValueError(f"no column for trace id {trace_id_col!r}")
    rows = ops.where(~F.col("ops").isin("STAR", "HEADER"))
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000)
    attributes = F.struct(*[F.col(c) for c in ops.columns if c not in ("ops", "ts")])
    return rows.select(
        "span_id",
        F.col(column).alias("trace_id"),
        "sql_id",
        "line",
        ns.alias("time_ns"),
        shown_op(F.col("ops")).alias("name"),
        attributes.alias("attributes"),
    )


def write_spans(
    ops: DataFrame, path: str, trace_id_col: str = "CLIENT ID", form: str = "json", across_files: bool = False
) -> None:
    """Write ``spans`` and ``events`` under ``path`` as JSON lines or Parquet."""
    if form not in ("json", "parquet"):
        raise ValueError(f"form must be 'json' or 'parquet', not {form!r}")
    export_spans(ops, trace_id_col, across_files).write.format(form).save(f"{path}/spans")
    export_events(ops, trace_id_col).write.format(form).save(f"{path}/events")
