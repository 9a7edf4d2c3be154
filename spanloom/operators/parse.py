"""From records to fact columns.

Each kind of record has its own small set of expressions (SQL texts over ``params``, ``value``,
``text``, ``keys`` and ``digits``); ``parse_records`` merges them into one projection guarded by the kind. Integers of ``key=value``
lists have the same keys in all kinds of records and are looked up the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spanloom.functions import trace_text as X
from spanloom.schema import OPS_SCHEMA

# Trace keys and the integer columns they fill, in any kind of record.
KEYS = {"c": "cpu_time", "e": "elapsed_time", "p": "ph_reads", "cr": "cr_reads", "cu": "current_reads",
        "mis": "cursor_missed", "r": "rows_processed", "dep": "rec_call_dp", "og": "opt_goal", "plh": "plh",
        "tim": "tim", "type": "c_type", "len": "len", "uid": "uid", "oct": "oct", "lid": "lid", "hv": "hv",
        "rlbk": "rlbk", "rd_only": "rd_only", "bytes": "bytes", "err": "error_code"}

# Filled by other operators (span, context, clock) or taken over unchanged.
_FROM_ELSEWHERE = {
    "span_id", "cursor_id", "ops", "file_name", "line", "sid", "client_id", "service_name", "module",
    "action", "container_id",
}
_TEXTS = {"event_name", "event_raw", "ad", "lobtype"}
_NULLABLE = {"sql_id", "ts"}
_KINDS = {key: OPS_SCHEMA[column].dataType.simpleString() for key, column in KEYS.items()}


def wait_fields() -> dict[str, str]:
    """Name, elapsed time and clock of a WAIT; the text is kept whole in ``event_raw``."""
    found = [f"regexp_extract(params, {X.quoted(X.WAIT_FIELDS)}, {i})" for i in range(5)]
    return {
        "event_name": f"trim(both \"'\" from {found[1]})",
        "elapsed_time": f"try_cast({found[2]} as bigint)",
        "tim": f"try_cast({found[4]} as bigint)",
        "event_raw": "params",
    }


def star_fields() -> dict[str, str]:
    """Wall clock lines, with or without a session attribute."""
    name, inner = (f"regexp_extract(value, r'{X.NAMED_STAR}', {i})" for i in (1, 2))
    return {
        "event_name": f"coalesce(nullif({name}, ''), 'DATETIME')",
        "event_raw": f"if({name} = '', null, trim(both '()' from {inner}))",
        "ts": "star_ts",
    }


def header_fields() -> dict[str, str]:
    return {
        "event_name": f"regexp_extract(value, r'{X.HEADER}', 1)",
        "event_raw": f"regexp_extract(value, r'{X.HEADER}', 2)",
    }


_TIMED_CALL = "ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE')"


# Fields that are no integers of a list, by kind of record.
_RULES = [
    ("ops = 'WAIT'", wait_fields()),
    ("ops = 'PIC'", {"ad": X.text("params", "ad", " "), "sql_id": X.text("params", "sqlid", " "), "event_raw": "text"}),
    ("ops = 'STAT'", {"event_raw": "params"}),
    ("ops = 'BINDS'", {"event_raw": "concat(params, coalesce(text, ''))"}),
    ("ops = 'PARSE ERROR'", {"event_raw": "text"}),
    ("kind = 'LOB'", {"lobtype": X.text("params", "type", ","), "c_type": "0"}),
    ("kind = 'STAR'", star_fields()),
    ("kind = 'HEADER'", header_fields()),
]


def _merged(column: str, kind: str) -> str:
    key = next((k for k, c in KEYS.items() if c == column), None)
    last = X.integer(key) if key else "null"
    cases = [f"when {when} then {fields[column]}" for when, fields in _RULES if column in fields]
    found = f"case {' '.join(cases)} else {last} end" if cases else last
    typed = found if kind in ("bigint", "string") else f"try_cast({found} as {kind})"
    if column in _TEXTS:
        blank = "if(kind = 'STAR', null, '')" if column == "event_raw" else "''"
        typed = f"coalesce({found}, {blank})"
    elif column == "tim":
        typed = f"nullif({typed}, 0)"
    elif column not in _NULLABLE:
        typed = f"coalesce({typed}, cast(0 as {kind}))"
    return f"{typed} as {column}"


def split_records(records: DataFrame, zone: str = "UTC") -> DataFrame:
    """Add ``ops``, ``cursor_id``, ``params`` (the line behind them), ``keys``, ``digits``, ``star_ts``."""
    cursor = records.selectExpr(
        "*", f"if(call <> '', regexp_extract(value, r'{X.CALL}', 2), null) as cursor_id"
    )
    outside = [f"regexp_extract(value, r'{X.LOB_OR_COMMIT}', {i})" for i in (0, 1, 2)]
    split = cursor.selectExpr(
        "*",
        f"""case when call = 'PARSING IN CURSOR' then 'PIC' when call <> '' then call
        when kind in ('LOB', 'XCTEND') then {outside[1]} else kind end as ops""",
        f"""case when call <> '' then substr(value, length(call) + length(cursor_id) + 3)
        when kind in ('LOB', 'XCTEND') then {outside[2]} end as params""",
    )
    items = f"""case when {_TIMED_CALL} or kind = 'LOB' then {X.separated('params', ',')}
        when ops in ('PIC', 'ERROR', 'PARSE ERROR') then {X.separated('params', ' ')}
        when ops = 'XCTEND' then {X.separated('params', ', ')} end as _items"""
    dated, named = (f"regexp_extract(value, r'{p}', {i})" for p, i in ((X.DATE_STAR, 1), (X.NAMED_STAR, 3)))
    stamp = f"if(kind = 'STAR', coalesce(nullif({dated}, ''), {named}), null) as stamp"
    listed = split.selectExpr("*", items, stamp)
    kept = [c for c in listed.columns if c not in ("_items", "stamp")]
    return listed.selectExpr(
        *kept,
        f"{X.integer_items('_items', 1)} as keys",
        f"{X.integer_items('_items', 2)} as digits",
        f"{X.utc_time('stamp', zone)} as star_ts",
    )


def parse_records(records: DataFrame, zone: str = "UTC") -> DataFrame:
    """Fact columns of assembled records, plus ``kind``, ``value`` and ``reject``.

    ``reject`` is NULL or says why the record is not stored: ``params`` (a broken item where all are
    needed), ``range`` (a number that its column does not hold), ``cursor`` (no valid handle) or ``time``. Missing integers are 0 and missing texts '';
    a missing ``tim`` is NULL. Resets and orphans pass through with an op of that name.
    """
    reject = f"""case
        when {_TIMED_CALL} and {X.broken_list()} then 'params'
        when ops = 'XCTEND' and {X.broken_commit()} then 'params'
        when kind = 'LOB' and {X.broken_list('type')} then 'params'
        when {X.out_of_range(_KINDS)} or ops = 'WAIT' and {X.wait_out_of_range()} then 'range'
        when cursor_id != '#0' and length(cursor_id) <= 2 then 'cursor'
        when kind = 'STAR' and star_ts is null then 'time'
        end as reject"""
    fields = [
        _merged(f.name, f.dataType.simpleString())
        for f in OPS_SCHEMA.fields
        if f.name not in _FROM_ELSEWHERE
    ]
    return split_records(records, zone).selectExpr(
        "file_name", "line", "kind", "value", reject, "ops", "cursor_id", *fields
    )
