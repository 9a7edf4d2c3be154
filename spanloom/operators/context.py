"""Session attributes: each record carries the latest ones of its file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spanloom.operators.carry import Mark, carry_forward
from spanloom.schema import OPS_SCHEMA

# Columns and the names of the lines that set them.
CONTEXT = {
    "sid": "SESSION ID",
    "client_id": "CLIENT ID",
    "service_name": "SERVICE NAME",
    "module": "MODULE NAME",
    "action": "ACTION NAME",
    "container_id": "CONTAINER ID",
}


def context_marks() -> dict[str, Mark]:
    return {
        f"_ctx_{column}": Mark(f"ops = 'STAR' and event_name = '{name}'", "event_raw")
        for column, name in CONTEXT.items()
    }


def finish_context(marked: DataFrame) -> DataFrame:
    kept = [c for c in marked.columns if c not in CONTEXT and not c.startswith("_ctx_")]
    kinds = {c: OPS_SCHEMA[c].dataType.simpleString() for c in CONTEXT}
    return marked.selectExpr(
        *kept, *[f"try_cast(_ctx_{c}.value as {kind}) as {c}" for c, kind in kinds.items()]
    )


def fill_context(ops: DataFrame) -> DataFrame:
    """Add the six session attributes, each from the latest line that set it."""
    return finish_context(carry_forward(ops, ["file_name"], "line", context_marks()))
