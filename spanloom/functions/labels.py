"""Small text helpers of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def statement_label(text: Column) -> Column:
    """First 29 characters of a statement on one line."""
    return F.regexp_replace(F.substring(text, 1, 29), "[\r\n]", "")


def short_path(path: Column, tail: int) -> Column:
    """Paths above 30 characters are shown by their end."""
    cut = F.concat(F.lit("<...>"), F.right(path, F.lit(tail)))
    return F.when(F.length(path) > 30, cut).otherwise(path)


def wait_label(event: Column, cursor: Column) -> Column:
    """Network waits outside of any cursor are idle time and get a name of their own."""
    idle = event.like("SQL*Net message%") & (cursor == F.lit("#0"))
    return F.when(idle, F.concat(event, F.lit("/idle"))).otherwise(event)
