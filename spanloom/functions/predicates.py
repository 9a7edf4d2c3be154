"""Row filters of the reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def preds(
    start: str | None = None,
    end: str | None = None,
    client_id: str | None = None,
    sql_ids: str | Iterable[str] | None = None,
) -> Column | None:
    """Conjunction of the given filters, or None when there is none.

    ``start`` is inclusive and ``end`` exclusive, both wall clock in UTC. ``sql_ids`` is a list or a
    comma separated string.
    """
    parts: list[Column] = []
    if start is not None:
        parts.append(F.col("ts") >= F.to_timestamp_ntz(F.lit(start)))
    if end is not None:
        parts.append(F.col("ts") < F.to_timestamp_ntz(F.lit(end)))
    if client_id is not None:
        parts.append(F.col("client_id") == F.lit(client_id))
    if sql_ids is not None:
        parts.append(F.col("sql_id").isin(id_list(sql_ids)))
    out: Column | None = None
    for part in parts:
        out = part if out is None else out & part
    return out


def id_list(sql_ids: str | Iterable[str]) -> list[str]:
    return sql_ids.split(",") if isinstance(sql_ids, str) else list(sql_ids)


def threshold(spec: str | int | Iterable[int] | None, value: Column) -> Column | None:
    """One number: above it. Two: between them, both included. None or '': no condition."""
    if spec is None or spec == "":
        return None
    if isinstance(spec, str):
        bounds = [int(s) for s in spec.split(",")]
    elif isinstance(spec, int):
        bounds = [spec]
    else:
        bounds = [int(s) for s in spec]
    if len(bounds) == 1:
        return value > F.lit(bounds[0])
    if len(bounds) == 2:
        return value.between(bounds[0], bounds[1])
    raise ValueError(f"a threshold has one or two numbers, got {len(bounds)}")
