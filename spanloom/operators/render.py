"""Records as users read them: named records and trace lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.plans.reports import shown_op


def shown_record(ops: DataFrame) -> DataFrame:
    """The row with its operation under the name it has in the trace file."""
    return ops.withColumn("operation", shown_op(F.col("ops")))


# The keys each kind of record prints, with the columns behind them.
_CALL = {"c": "cpu_time", "e": "elapsed_time", "p": "ph_reads", "cr": "cr_reads", "cu": "current_reads",
         "mis": "cursor_missed", "r": "rows_processed", "dep": "rec_call_dp", "og": "opt_goal", "plh": "plh",
         "tim": "tim", "fname": "file_name", "line": "line"}
_PARSED = {"len": "len", "dep": "rec_call_dp", "uid": "uid", "oct": "oct", "lid": "lid", "tim": "tim",
           "hv": "hv", "ad": "ad", "sqlid": "sql_id"}
_PARSE_ERROR = {"len": "len", "dep": "rec_call_dp", "uid": "uid", "oct": "oct", "lid": "lid", "tim": "tim",
                "err": "error_code"}
_LOB = {"type": "lobtype", "bytes": "bytes", "c": "cpu_time", "e": "elapsed_time", "p": "ph_reads",
        "cr": "cr_reads", "cu": "current_reads", "tim": "tim"}
_COMMIT = {"rlbk": "rlbk", "rd_only": "rd_only", "tim": "tim"}
_ERROR = {"err": "error_code", "tim": "tim"}


def _pairs(keys: dict[str, str], separator: str) -> Column:
    parts = []
    for key, column in keys.items():
        value = F.coalesce(F.col(column).cast("string"), F.lit("0" if key == "tim" else ""))
        parts.append(F.concat(F.lit(f"{key}="), value))
    return F.concat_ws(separator, *parts)


def render_line(ops: DataFrame, name: str = "rendered") -> DataFrame:
    """Add the text form of every record of the fact table as column ``name``."""
    op = F.col("ops")
    cursor = F.coalesce("cursor_id", F.lit(""))
    raw = F.coalesce("event_raw", F.lit(""))
    text = (
        F.when(op.isin("WAIT", "STAT", "BINDS"), F.concat(cursor, F.lit(": "), op, F.lit(" "), raw))
        .when(
            op.isin("PARSE", "EXEC", "FETCH", "CLOSE"),
            F.concat(cursor, F.lit(": "), op, F.lit(" "), _pairs(_CALL, ",")),
        )
        .when(
            op == "PIC",
            F.concat(
                F.lit("PARSING IN CURSOR "), _pairs(_PARSED, " "), F.lit("\n"), raw,
                F.lit("\nEND OF STMT"),
            ),
        )
        .when(op == "ERROR", F.concat(F.lit("ERROR "), cursor, F.lit(":"), _pairs(_ERROR, " ")))
        .when(
            op == "PARSE ERROR",
            F.concat(F.lit("PARSE ERROR "), cursor, F.lit(":"), _pairs(_PARSE_ERROR, " ")),
        )
        .when(op == "XCTEND", F.concat(F.lit("XCTEND "), _pairs(_COMMIT, ", ")))
        .when(op == "HEADER", F.concat("event_name", F.lit(": "), raw))
        .when(
            op == "STAR",
            F.concat(
                F.lit("*** "), "event_name", F.lit(":("), raw, F.lit(") "),
                F.coalesce(F.col("ts").cast("string"), F.lit("")),
            ),
        )
        .otherwise(F.concat(op, F.lit(": "), _pairs(_LOB, ",")))
    )
    return ops.withColumn(name, text)
