"""Layout of the fact table: one row per traced database call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, order and meaning of the stored table, and its version.
SCHEMA_VERSION = "0.4"
_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}
OPS_SCHEMA = T.StructType(
    [
        T.StructField(name, _TYPES[kind])
        for name, kind in [
            ("span_id", "bigint"),
            ("sql_id", "string"),
            ("cursor_id", "string"),
            ("ops", "string"),
            ("cpu_time", "bigint"),
            ("elapsed_time", "bigint"),
            ("ph_reads", "bigint"),
            ("cr_reads", "bigint"),
            ("current_reads", "bigint"),
            ("cursor_missed", "int"),
            ("rows_processed", "bigint"),
            ("rec_call_dp", "int"),
            ("opt_goal", "int"),
            ("plh", "bigint"),
            ("tim", "bigint"),
            ("c_type", "int"),
            ("event_name", "string"),
            ("event_raw", "string"),
            ("file_name", "string"),
            ("line", "bigint"),
            ("ts", "timestamp_ntz"),
            ("len", "bigint"),
            ("uid", "bigint"),
            ("oct", "int"),
            ("lid", "int"),
            ("hv", "bigint"),
            ("ad", "string"),
            ("rlbk", "int"),
            ("rd_only", "int"),
            ("lobtype", "string"),
            ("bytes", "bigint"),
            ("sid", "string"),
            ("client_id", "string"),
            ("service_name", "string"),
            ("module", "string"),
            ("action", "string"),
            ("container_id", "int"),
            ("error_code", "int"),
        ]
    ]
)
OPS_COLUMNS = OPS_SCHEMA.fieldNames()

# The operations that may occur once per span, and those that may repeat.
SINGLE_OPS = ["PIC", "PARSE", "EXEC", "CLOSE", "BINDS", "ERROR", "PARSE ERROR"]
REPEATED_OPS = ["FETCH", "WAIT", "STAT"]
TRACKED_OPS = SINGLE_OPS + REPEATED_OPS


def conform(df: DataFrame) -> DataFrame:
    """Cast to the fact schema; columns that already have the type are passed as they are.

    An untouched column keeps its filters pushable to the scan, so only real differences
    (unsigned integers, zoned timestamps) get a cast. ``tim`` 0 means "no time" in stored files.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for field in OPS_SCHEMA.fields:
        kind = have.get(field.name)
        if kind is None:
            column = F.lit(None).cast(field.dataType)
        elif kind == field.dataType:
            column = F.col(field.name)
        else:
            column = F.col(field.name).cast(field.dataType)
        if field.name == "tim":
            column = F.nullif(column, F.lit(0).cast("bigint"))
        out.append(column.alias(field.name))
    return df.select(*out)
