"""Trace text to fact table."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.carry import carry_forward
from spanloom.operators.classify import assemble, classify
from spanloom.operators.clock import clock_marks, finish_clock
from spanloom.operators.context import context_marks, finish_context
from spanloom.operators.parse import parse_records
from spanloom.operators.sequence import in_sequence, out_of_sequence, place_files
from spanloom.operators.spans import (
    cut_spans,
    number_spans,
    only_line,
    repeated_starts,
    reset_marks,
    resolve_sql_id,
)
from spanloom.schema import OPS_COLUMNS
from spanloom.sources.files import file_dictionary, number_files
from spanloom.sources.stage import stage
from spanloom.sources.trace import read_lines


@dataclass(frozen=True)
class Totals:
    """What one ingest read, and the seconds until its records were resolved; counted while its tables are written."""

    lines: int
    records: int
    rejects: int
    orphans: int
    seconds: float


@dataclass(frozen=True)
class Ingest:
    """Results of one ingest: lazy reads of staged tables."""

    ops: DataFrame
    rejects: DataFrame
    orphans: DataFrame
    records: DataFrame
    totals: Totals


# Records that go on to the fact table or to the operators that fill it.
STORED = "reject is null and kind <> 'ORPHAN'"


def ingest(
    source: SparkSession | DataFrame,
    paths: str | Iterable[str] | None = None,
    ids: str = "hash",
    zone: str = "UTC",
    attach_lobs: bool = False,
    stream_key: str | None = None,
    dictionary: str | None = None,
) -> Ingest:
    """Parse trace files (or a DataFrame of numbered lines) into the fact table.

    ``stream_key``, SQL over ``file_name``, names the process that wrote a file: its files, in the order of their
    first wall clock, go on with each other's cursors, statement ids and clock (see ``operators.sequence``).
    Session attributes and text records end with their file. Without it every file stands alone.
    ``ids`` is as in ``number_spans``; ``dictionary`` is the path of the file numbers of unique ids, which keeps them
    apart from those of other ingests into the same table. Spans of a sequence are numbered by it, not by
    file.

    Staged tables: the classified lines, which are read once for records of one line and once for
    the others; the parsed records, so that block states can be read from a few columns; the
    records with all running values of their file and cursor, which feed the span walk, the clock
    and the final projection; and the few lines where a repeated call starts a span.
    """
    begun = time.monotonic()
    lines = source if isinstance(source, DataFrame) else read_lines(source, paths)
    seen, parsed = Observation(), Observation()
    classified = stage(classify(lines.observe(seen, F.count(F.lit(1)).alias("lines")), base=lines), "lines")
    counts = {
        "records": f"{STORED} and kind <> 'RESET'",
        "rejects": "reject is not null",
        "orphans": "kind = 'ORPHAN'",
    }
    records = parse_records(assemble(classified), zone)
    records = stage(records.observe(parsed, *[F.expr(f"count_if({c}) as {n}") for n, c in counts.items()]), "records")
    stored = records.where(STORED).drop("kind", "value", "reject")
    cut, segmented = resolve(stored, attach_lobs, stream_key)
    ops = finish_spans(cut, segmented, ids, dictionary)
    return Ingest(
        ops=(ops if stream_key is None else out_of_sequence(ops)).select(*OPS_COLUMNS),
        rejects=records.where(F.col("reject").isNotNull()).select(
            "file_name", "line", "value", F.col("reject").alias("reason")
        ),
        orphans=records.where(F.col("kind") == "ORPHAN").select("file_name", "line", "value"),
        records=records,
        totals=Totals(**seen.get, **parsed.get, seconds=time.monotonic() - begun),
    )


def resolve(stored: DataFrame, attach_lobs: bool = False, stream_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted records with all running values, as a table, and the same cut into spans (file, cursor, mark)."""
    of_process = {**clock_marks(), **reset_marks()}
    if stream_key is None:
        base = stored
        running = finish_context(carry_forward(stored, ["file_name"], "line", {**context_marks(), **of_process}))
    else:
        places = stage(place_files(stored, stream_key), "file_places")
        base = in_sequence(stored, places)
        with_context = finish_context(carry_forward(stored, ["file_name"], "line", context_marks()))
        running = carry_forward(in_sequence(with_context, places), ["file_name"], "line", of_process, base=base)
    running = resolve_sql_id(running, base=base)
    segmented = stage(only_line(running, "_reset"), "running")
    return cut_spans(segmented, stage(repeated_starts(segmented), "starts"), attach_lobs), segmented


def finish_spans(cut: DataFrame, segmented: DataFrame, ids: str, dictionary: str | None = None) -> DataFrame:
    """Wall clock and ``span_id`` of records that are cut into spans."""
    resets = segmented.where("ops = 'RESET'").select("file_name", "line")
    numbers = None
    if ids == "unique":
        names = segmented.select("file_name")
        numbers = number_files(names) if dictionary is None else file_dictionary(names, dictionary)
    return number_spans(finish_clock(cut), ids, resets, segmented, numbers)


def ingest_stats(lines: DataFrame, rejects: DataFrame) -> DataFrame:
    """Lines and rejected records per file."""
    per_file = lines.groupBy("file_name").agg(F.count("*").alias("lines"))
    errors = rejects.groupBy("file_name").agg(F.count("*").alias("errors"))
    return per_file.join(errors, "file_name", "left").select(
        "file_name", "lines", F.coalesce("errors", F.lit(0)).alias("errors")
    )
