"""From numbered lines to records: what each line is, and which lines belong together.

Input: ``file_name, line, value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions import trace_text as X
from spanloom.operators.carry import Mark, carry_forward

MULTILINE = ["PARSING IN CURSOR", "BINDS", "PARSE ERROR"]


def classify(lines: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Add ``kind``, ``call`` (operation of a call line) and ``owner`` (record of a text line).

    Kinds: CALL, TEXT (continues the owner), END (of a statement), LOB, XCTEND, RESET, STAR,
    HEADER and ORPHAN. What a line means depends on the latest call line and on whether a statement
    end has passed since, nothing else; both are carried forward, from the same lines as ``base`` if it is
    given. Blank and preamble lines go.
    """

    def called(some: DataFrame) -> DataFrame:
        kept = some.where(f"line > {X.PREAMBLE_LINES} and length(value) > 0")
        return kept.selectExpr("*", f"{X.call_op('value')} as call")

    rows = called(lines)
    ends = f"startswith(value, '{X.STATEMENT_END}')"
    state = carry_forward(
        rows,
        ["file_name"],
        "line",
        {"_owner": Mark("call <> ''", "call"), "_end": Mark(ends, "true", strict=True)},
        base=None if base is None else called(base),
    )
    in_statement = "_owner.value = 'PARSING IN CURSOR' and coalesce(_end.at, 0L) < _owner.at"
    kind = f"""case
        when call <> '' then 'CALL'
        when _owner.value = 'BINDS' and startswith(value, ' ') then 'TEXT'
        when _owner.value = 'PARSE ERROR' then 'TEXT'
        when {in_statement} and {ends} then 'END'
        when {in_statement} then 'TEXT'
        when startswith(value, 'XCTEND') and rlike(value, r'^XCTEND:* ') then 'XCTEND'
        when startswith(value, 'LOB') and rlike(value, r'{X.LOB_OR_COMMIT}') then 'LOB'
        when startswith(value, '{X.RESET}') then 'RESET'
        when startswith(value, '***') and (rlike(value, r'{X.DATE_STAR}') or rlike(value, r'{X.NAMED_STAR}')) then 'STAR'
        when rlike(value, r'{X.HEADER}') then 'HEADER'
        else 'ORPHAN' end as kind"""
    return state.selectExpr(*lines.columns, "call", kind, "_owner.at as _at").selectExpr(
        *lines.columns, "call", "kind", "if(kind = 'TEXT', _at, null) as owner"
    )


def assemble(classified: DataFrame) -> DataFrame:
    """One row per record, with ``text``: its continuation lines, each ended by a line feed.

    Only the records that can have more lines, and those lines, are grouped; all other rows pass
    without a shuffle. The state of a group is the text of one record.
    """
    many = f"(kind = 'TEXT' or call in ({', '.join(repr(m) for m in MULTILINE)}))"
    single = classified.where(f"not {many} and kind <> 'END'").selectExpr(
        "file_name", "line", "kind", "call", "value", "cast(null as string) as text"
    )
    grouped = (
        classified.where(many)
        .groupBy("file_name", F.expr("coalesce(owner, line) as _record"))
        .agg(
            F.expr("max(if(kind = 'CALL', named_struct('call', call, 'value', value), null)) as _head"),
            F.expr(
                "sort_array(collect_list(if(kind = 'TEXT', named_struct('line', line, 'value', value), null)))"
                " as _lines"
            ),
        )
        .selectExpr(
            "file_name",
            "_record as line",
            "'CALL' as kind",
            "_head.call",
            "_head.value",
            "array_join(transform(_lines, x -> concat(x.value, chr(10))), '') as text",
        )
    )
    return single.unionByName(grouped)
