"""Patterns and names of the trace text format, and readers of its fields.

Field readers are SQL texts. The integer items of a ``key=value`` list are found once per record,
and every field is a lookup in them: much cheaper than one search of the line per key.
"""

from __future__ import annotations

# The line forms of the trace format.
CALL = r"^(PARSE|EXEC|FETCH|WAIT|CLOSE|STAT|ERROR|PARSING IN CURSOR|BINDS|PARSE ERROR) (#\d+)(?::| )(.*)"
STATEMENT_END = "END OF STMT"
LOB_OR_COMMIT = r"^(LOB[A-Z]+|XCTEND):* (.*)"
RESET = "=" * 21
DATE_STAR = r"^\*{3} (\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}[+-]\d\d:\d\d)"
NAMED_STAR = (
    r"^\*\*\* (SESSION ID|CLIENT ID|SERVICE NAME|MODULE NAME|ACTION NAME|CLIENT DRIVER"
    r"|CONTAINER ID|CLIENT IP|CONNECTION ID):(\(.*\)) (.*)"
)
HEADER = (
    r"^(Build label|ORACLE_HOME|System name|Node name|Release|Version|Machine|CLID|Instance name"
    r"|Instance number|Database name|Database unique name|Database unique id"
    r"|Redo thread mounted by this instance|Oracle process number|Unix process pid):\s+(.*)"
)
WAIT_FIELDS = r"^ nam='(.*)' ela= (\d+) (.*) tim=(\d+)"
PREAMBLE_LINES = 3



def quoted(text: str) -> str:
    """SQL literal of a text, taken as it is."""
    return "r'" + text + "'" if "'" not in text else 'r"' + text + '"'


def separated(params: str, separator: str) -> str:
    """SQL: list with one common separator, also in front, so that a match begins with it."""
    return f"concat(chr(1), replace({params}, '{separator}', chr(1)))"


def integer_items(items: str, group: int) -> str:
    """SQL: keys (group 1) or digits (group 2) of all ``key=integer`` items, last one first."""
    pattern = r"\x01([^\x01=]*)=\s*([+-]?\d+)[ \t]*?(?=[\x01=]|$)"
    return f"reverse(regexp_extract_all({items}, r'{pattern}', {group}))"


def integer(key: str) -> str:
    """SQL: integer of ``key=…``, the last one if it is repeated; NULL if absent or no integer."""
    return f"try_cast(get(digits, cast(array_position(keys, '{key}') as int) - 1) as bigint)"


def text(params: str, key: str, separator: str) -> str:
    """SQL: text of ``key=…`` in a list, without quotes around it; '' if absent."""
    pattern = rf"^(?:.*{separator})?{key}=([^{separator}=]*)"
    return f"trim(both \"'\" from regexp_extract({params}, r'{pattern}', 1))"


def broken_list(text_key: str = "") -> str:
    """SQL: has a comma list an item that is not ``key=integer`` (``text_key`` may have any text)?

    As many integer items as commas and one more: all are fine. Else the items are looked at one by
    one. The lambda also keeps the wide parse projection out of whole-stage code generation, which
    would put it into one method, too long for the JIT compiler.
    """
    known = f"x = '' or startswith(x, '{text_key}=') or " if text_key else "x = '' or "
    one = r"rlike(x, r'^[^=]*=\s*[+-]?\d+[ \t]*(=.*)?$')"
    items = "length(params) - length(replace(params, ',', '')) + 1"
    return f"(size(keys) <> {items} and exists(split(params, ','), x -> not ({known}{one})))"


def broken_commit() -> str:
    """SQL: is some item, an empty one included, not ``key=integer``?"""
    one = r"rlike(x, r'^[^=]*=\s*[+-]?\d+[ \t]*(=.*)?$')"
    return f"exists(split(params, ', '), x -> not {one})"


def out_of_range(kinds: dict[str, str]) -> str:
    """SQL: has one of the keys of ``kinds`` (key -> type) an integer that its type does not hold?

    A search of the line for long numbers goes first, so that few records are looked at by item.
    """
    small = [k for k, kind in kinds.items() if kind == "int"]
    long = rf"=\s*[+-]?\d{{19}}|(?:^|[, ])(?:{'|'.join(small)})=\s*[+-]?\d{{10}}"
    known, ints = (", ".join(repr(k) for k in keys) for keys in (kinds, small))
    beyond = f"""x.keys in ({known}) and try_cast(x.digits as bigint) is null
        or x.keys in ({ints}) and try_cast(x.digits as int) is null"""
    return f"(rlike(params, r'{long}') and exists(arrays_zip(keys, digits), x -> {beyond}))"


def wait_out_of_range() -> str:
    """SQL: has a WAIT a time that a bigint does not hold?"""
    found = [f"regexp_extract(params, {quoted(WAIT_FIELDS)}, {i})" for i in (2, 4)]
    beyond = " or ".join(f"({f} <> '' and try_cast({f} as bigint) is null)" for f in found)
    return rf"(rlike(params, r'\d{{19}}') and ({beyond}))"


def utc_time(text: str, zone: str = "UTC") -> str:
    """SQL: wall clock in UTC of ``2023-05-19T05:28:00.339263+02:00``; NULL if it is no time.

    The offset is applied as an interval, so the result does not depend on the session time zone.
    Text without an offset is taken as local time of ``zone``.
    """
    pattern = r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{1,6})(?:([+-])(\d\d):(\d\d))?$"
    part = [f"regexp_extract({text}, r'{pattern}', {i})" for i in range(5)]
    local = f"try_cast({part[1]} as timestamp_ntz)"
    sign = f"if({part[2]} = '-', -1, 1)"
    minutes = f"{sign} * (try_cast({part[3]} as int) * 60 + try_cast({part[4]} as int))"
    named = local if zone == "UTC" else f"convert_timezone('{zone}', 'UTC', {local})"
    return f"if({part[2]} = '', {named}, {local} - make_dt_interval(0, 0, {minutes}))"


def call_op(value: str) -> str:
    """SQL: operation of a call line, '' for other lines."""
    return f"regexp_extract({value}, r'{CALL}', 1)"
