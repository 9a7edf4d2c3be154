"""Row functions in Arrow batches, and other helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_STEP = 400  # rows that become Python objects at a time


def nullable(schema: str | T.StructType) -> T.StructType:
    fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def others(df: DataFrame, *taken: str) -> Column:
    """The columns of ``df`` besides ``taken`` as one struct, whatever their names."""
    return F.struct([F.col(f"`{c}`") for c in df.columns if c not in taken] or [F.lit(None).cast("string").alias("none")])


def hashed_sample(df: DataFrame, most: int, *by: str, seed: int = 0) -> DataFrame:
    """At most ``most`` rows, the first by a hash of ``by``, and as good as ``most`` where there are so many.

    Each partition first leaves out what can't be among them by its share of all rows, so the one task that
    orders the rest gets a few times ``most`` rows, however many partitions there are.
    """
    share = min(1.0, 4 * most / max(1, df.count()))
    hashed = F.xxhash64(*by, F.lit(seed))
    near = F.pmod(F.xxhash64(hashed), F.lit(1 << 30)) < int(share * (1 << 30))
    return df.where(near).orderBy(hashed, *by).limit(most)


def slices(batches: Iterable[pa.RecordBatch], step: int = _STEP) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_rows(df: DataFrame, build: Callable, inputs: list[str], outputs: str) -> DataFrame:
    """``df`` with the columns ``outputs`` (a DDL string) appended.

    ``build()`` runs once per task and returns the function that maps the values of ``inputs`` of one
    row to the tuple of its outputs. The rows stay in their partition.
    """
    schema = nullable(T.StructType(df.schema.fields + nullable(outputs).fields))
    arrow = to_arrow_schema(schema)
    added = list(arrow)[len(df.columns) :]
    places = [df.columns.index(c) for c in inputs]

    def run(batches):
        fn = build()
        for part in slices(batches):
            rows = [fn(*v) for v in zip(*(part.column(i).to_pylist() for i in places), strict=True)]
            new = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), added, strict=True)]
            kept = [c.cast(f.type) for c, f in zip(part.columns, arrow, strict=False)]
            yield pa.RecordBatch.from_arrays(kept + new, schema=arrow)

    return df.mapInArrow(run, schema)


def flat_map(df: DataFrame, build: Callable, outputs: str) -> DataFrame:
    """Rows ``outputs`` made from slices of ``df``: ``build()`` gives a function from a slice (Arrow) to
    lists of column values, or None for a slice that makes no rows."""
    schema = nullable(outputs)
    arrow = to_arrow_schema(schema)

    def run(batches):
        fn = build()
        for part in slices(batches):
            columns = fn(part)
            if columns is not None and len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)
