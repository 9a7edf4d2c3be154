"""Wall clock of records that only have a monotonic clock."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spanloom.operators.carry import Mark, carry_forward

_TIMED = "(tim is not null and ops not in ('STAR', 'HEADER', 'RESET'))"


def clock_marks() -> dict[str, Mark]:
    """The latest wall clock line, the latest timed record, and the first timed one since that line."""
    return {
        "_anchor": Mark("ops = 'STAR' and ts is not null", "ts"),
        "_timed": Mark(_TIMED, "tim"),
        "_first": Mark(_TIMED, "tim", since="_anchor"),
    }


def finish_clock(marked: DataFrame) -> DataFrame:
    """``ts`` = latest wall clock line + time since the first timed record after that line.

    A record without a clock takes the reading of the latest timed record since the wall clock line,
    or the line's own if there is none. Without a wall clock line ``ts`` stays NULL.
    """
    reading = """case when ops in ('STAR', 'HEADER') then ts else timestampadd(MICROSECOND,
        coalesce(case when _timed.at > _anchor.at then _timed.value - _first.value end, 0L), _anchor.value) end as ts"""
    kept = [c for c in marked.columns if c not in ("ts", *clock_marks())]
    return marked.selectExpr(*kept, reading)


def assign_clock(ops: DataFrame) -> DataFrame:
    """Fill ``ts`` of all records from the wall clock lines of their file."""
    return finish_clock(carry_forward(ops, ["file_name"], "line", clock_marks()))
