"""Files that one process wrote one after the other, as one sequence of lines.

A process that rotates its trace goes on with open cursors, known statements and a running clock in the next
file. Operators with a running state take a key and an order; for a sequence the key is the process, and the
order is the line plus the place where its file begins in the sequence. Files begin on block borders, so the
state of a block belongs to one file, and state is carried over blocks and files alike by one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.carry import BLOCK_LINES


def place_files(records: DataFrame, stream_key: str, size: int = BLOCK_LINES) -> DataFrame:
    """``file_name, _stream, _shift``: the sequence that each file belongs to and where in it the file begins.

    ``stream_key`` is SQL over ``file_name``; a file for which it is NULL or empty is a sequence of its own. Files
    follow by their first wall clock, those without one come last; ties go by name. ``records`` has ``file_name,
    line, ops, ts`` with the wall clock lines' own ``ts``. One row per file, in windows by sequence.
    """
    files = records.groupBy("file_name").agg(
        F.expr("min_by(ts, line) filter (where ops = 'STAR' and ts is not null) as _since"),
        F.expr("max(line) as _last"),
    )
    named = files.selectExpr("*", f"coalesce(nullif(cast({stream_key} as string), ''), file_name) as _stream")
    blocks = f"(_last div {size}L + 1)"
    before = "partition by _stream order by _since is null, _since, file_name rows between unbounded preceding and 1 preceding"
    return named.selectExpr("file_name", "_stream", f"{size}L * coalesce(sum({blocks}) over ({before}), 0L) as _shift")


def in_sequence(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` with the sequence as ``file_name`` and the place in it as ``line``; their own are kept as ``_file``
    and ``_line``. The few rows per file reach the others by a broadcast if they turn out small."""
    kept = [c for c in rows.columns if c not in ("file_name", "line")]
    return rows.join(files, "file_name").selectExpr(
        "_stream as file_name", "line + _shift as line", *kept, "file_name as _file", "line as _line"
    )


def out_of_sequence(rows: DataFrame) -> DataFrame:
    """``rows`` with their own file and line again."""
    kept = [c for c in rows.columns if c not in ("file_name", "line", "_file", "_line")]
    return rows.selectExpr("_file as file_name", "_line as line", *kept)

