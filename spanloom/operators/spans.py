"""Grouping of calls into client interactions (spans).

On a cursor a span starts with a parse record, with the first call after a reset line of the file,
and with a second call of a kind that may occur once per span. The first two cut the calls of a
cursor into segments and are plain running values. The third is greedy inside a segment: it depends
on which kinds the current span has seen, a set of six. Such a state machine has 64 states, and what
a run of calls does to it is a function from state to state; functions of adjacent runs compose.
So runs are short blocks of lines, their functions are composed over blocks and over blocks of
blocks, and every block is then walked once from its known entry state. A segment of any length
never meets in one task; only calls that may occur once take part, the bulk (fetches, waits) inherit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.carry import Mark, block_of, carry_forward
from spanloom.schema import SINGLE_OPS, TRACKED_OPS
from spanloom.sources.files import number_files
from spanloom.sources.stage import stage

ONCE_OPS = [op for op in SINGLE_OPS if op != "PIC"]
_STATES = 1 << len(ONCE_OPS)
_LETTERS = "".join(chr(ord("0") + s) for s in range(_STATES))
WALK_LINES = 1 << 13
WALK_LEVELS = 1


_TRACKED = f"ops in ({', '.join(repr(op) for op in TRACKED_OPS)})"
# Handles are #0 or longer than one digit.
_VALID_CURSOR = "coalesce(cursor_id = '#0' or length(cursor_id) > 2, false)"


def validate(ops: DataFrame) -> DataFrame:
    """Add ``reject``: why a call can not take part in a span, else NULL."""
    other = "ops in ('XCTEND', 'STAR', 'HEADER', 'RESET') or startswith(ops, 'LOB')"
    return ops.selectExpr(
        "*",
        f"""case when not ({_TRACKED} or {other}) then 'ops'
        when {_TRACKED} and not {_VALID_CURSOR} then 'cursor'
        when startswith(ops, 'LOB') and cursor_id is not null then 'cursor' end as reject""",
    )


def reset_marks() -> dict[str, Mark]:
    return {"_reset": Mark("ops = 'RESET'", "true")}


def only_line(marked: DataFrame, mark: str) -> DataFrame:
    """Replace a mark by its line."""
    kept = [c for c in marked.columns if c != mark]
    return marked.selectExpr(*kept, f"{mark}.at as {mark}")


def resolve_sql_id(ops: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Give every call the statement id of the latest parse record on its cursor.

    A parse record always starts a span, so this is also the latest one at the span's start.
    Leaves ``_pic``, the line of that record.
    """
    marks = {"_pic": Mark("ops = 'PIC'", "coalesce(sql_id, '')")}
    filled = carry_forward(ops, ["file_name", "cursor_id"], "line", marks, base=base)
    kept = [c for c in ops.columns if c != "sql_id"]
    return filled.selectExpr(*kept, "_pic.value as sql_id", "_pic.at as _pic")


def segment_calls(ops: DataFrame) -> DataFrame:
    """Add what ``cut_spans`` needs: statement id, and lines of the latest reset and parse."""
    marked = only_line(carry_forward(ops, ["file_name"], "line", reset_marks()), "_reset")
    return resolve_sql_id(marked, base=ops)


def _step(state: int, op: int) -> int:
    bit = 1 << op
    return bit if state & bit else state | bit


# SQL: per call kind, the letters of the states that follow the states ``_LETTERS``. Raw literals,
# since one of the letters is the backslash.
_FUNCTIONS = ", ".join(
    "r'" + "".join(_LETTERS[_step(s, op)] for s in range(_STATES)) + "'" for op in range(len(ONCE_OPS))
)
_START = _LETTERS[0]


def _composed(function: str) -> str:
    """SQL: state function of ``_items``, whose elements x have the given state function."""
    return f"aggregate(_items, r'{_LETTERS}', (acc, x) -> translate(acc, r'{_LETTERS}', {function}))"


def _collected(rows: DataFrame, keys: list[str], *fields: str) -> DataFrame:
    """Ordered list per key; ``keys`` end with a block number, which bounds the list."""
    return rows.groupBy(*keys).agg(
        F.expr(f"sort_array(collect_list(struct({', '.join(fields)}))) as _items")
    )


def _entry_states(blocks: DataFrame, keys: list[str], size: int, levels: int) -> DataFrame:
    """Letter of the state each block is entered in: ``keys, _walk, _entry``."""
    if levels == 0:
        lists = _collected(blocks, keys, "_walk", "_function").selectExpr("*", f"'{_START}' as _enter")
    else:
        upper = blocks.selectExpr("*", f"{block_of('_walk', size)} as _up")
        lists = _collected(upper, [*keys, "_up"], "_walk", "_function")
        above = lists.selectExpr(*keys, "_up as _walk", f"{_composed('x._function')} as _function")
        entries = _entry_states(above, keys, size, levels - 1).selectExpr(
            *keys, "_walk as _up", "_entry as _enter"
        )
        lists = lists.join(entries, [*keys, "_up"])
    path = """aggregate(_items, named_struct('state', _enter, 'path', ''), (acc, x) -> named_struct(
        'state', substring(x._function, ascii(acc.state) - 47, 1), 'path', concat(acc.path, acc.state))).path"""
    return (
        lists.selectExpr(*keys, "_items._walk as _walk", f"split({path}, '') as _entry")
        .selectExpr(*keys, "inline(arrays_zip(_walk, _entry))")
        .where("_walk is not null")
    )


def repeated_starts(
    segmented: DataFrame, size: int = WALK_LINES, levels: int = WALK_LEVELS
) -> DataFrame:
    """Lines that start a span because their kind is already in the current one."""
    keys = ["file_name", "cursor_id", "_segment"]
    kinds = ", ".join(repr(op) for op in ONCE_OPS)
    once = segmented.where(f"ops in ({kinds})").selectExpr(
        "file_name",
        "cursor_id",
        f"{_SEGMENT} as _segment",
        "line",
        f"cast(array_position(array({kinds}), ops) as int) as _kind",
    )
    once = once.selectExpr("*", f"{block_of('(line - _segment)', size)} as _walk")
    walks = _collected(once, [*keys, "_walk"], "line", "_kind")

    # Block 0 of a segment is entered in the start state; only longer segments need composition.
    long = once.where("_walk > 0").select(*keys).distinct()
    function = _composed(f"element_at(array({_FUNCTIONS}), x._kind)")
    functions = walks.join(long, keys, "left_semi").selectExpr(
        *keys, "_walk", f"{function} as _function"
    )
    entries = _entry_states(functions, keys, size, levels)
    first = walks.where("_walk = 0").selectExpr(*keys, "_items", f"'{_START}' as _entry")
    later = walks.where("_walk > 0").join(entries, [*keys, "_walk"])
    entered = first.unionByName(later.select(*keys, "_items", "_entry"))
    bit = "shiftleft(1, x._kind - 1)"
    again = f"(acc.seen & {bit}) <> 0"
    path = f"""aggregate(_items, named_struct('seen', ascii(_entry) - 48, 'path', ''), (acc, x) -> named_struct(
        'seen', if({again}, {bit}, acc.seen | {bit}), 'path', concat(acc.path, if({again}, '1', '0')))).path"""
    return (
        entered.selectExpr("file_name", "cursor_id", "_items.line as line", f"split({path}, '') as _starts")
        .selectExpr("file_name", "cursor_id", "inline(arrays_zip(line, _starts))")
        .where("_starts = '1'")
        .drop("_starts")
    )


_SEGMENT = "greatest(coalesce(_reset, 0L), coalesce(_pic, 0L))"


def cut_spans(segmented: DataFrame, starts: DataFrame, attach_lobs: bool = False) -> DataFrame:
    """Add ``_mark``: with file and cursor it names the span. Reset lines are dropped.

    The mark is the line of the latest reset, parse or repeated call; records outside of cursors
    are spans of one row and have their own line. With ``attach_lobs`` a large-object record joins
    the span of the latest call of its file.
    """
    started = segmented.selectExpr("*", "cast(null as bigint) as _start").unionByName(
        starts.selectExpr("*", "line as _start"), allowMissingColumns=True
    )
    filled = carry_forward(
        started,
        ["file_name", "cursor_id"],
        "line",
        {"_started": Mark("_start is not null", "true", peers=True)},
    ).where("ops <> 'RESET'")
    kept = [c for c in segmented.columns if c not in ("_reset", "_pic")]
    out = filled.selectExpr(
        *kept,
        f"if({_TRACKED}, greatest({_SEGMENT}, coalesce(_started.at, 0L)), line) as _mark",
        "coalesce(cursor_id, '') as _cursor",
    )
    if attach_lobs:
        latest = {"_latest": Mark(_TRACKED, "struct(_cursor, _mark, sql_id)")}
        joins = "startswith(ops, 'LOB') and _latest is not null"
        moved = ("_cursor", "_mark", "sql_id")
        kept = [c for c in out.columns if c not in moved]
        out = carry_forward(out, ["file_name"], "line", latest).selectExpr(
            *kept, *[f"if({joins}, _latest.value.{c}, {c}) as {c}" for c in moved]
        )
    return out


def _dense_ids(cut: DataFrame, resets: DataFrame) -> DataFrame:
    """Consecutive numbers in the order in which spans close: ``file_name, _cursor, _mark, span_id``.

    A span closes at the next span of its cursor or at the next reset line, whichever comes first; of
    several, the cursor seen first goes first; open ones come last in their file. The numbering is
    by blocks: a count per block, running totals over blocks and files, ranks inside a block.
    """
    keys = ["file_name", "_cursor"]
    spans = stage(
        cut.groupBy(*keys, "_mark").agg(
            F.expr("min(line) as _first"),
            F.expr("max(line) as _last"),
            F.expr(f"bool_or({_TRACKED}) as _tracked"),
        ),
        "spans",
    )
    seen = spans.groupBy(*keys).agg(F.expr("min(_first) as _seen"))
    spans = spans.join(seen, keys).selectExpr("*", "-_first as _back")
    spans = carry_forward(spans, keys, "_back", {"_next": Mark("true", "_first", strict=True)})
    with_resets = spans.selectExpr(
        *keys, "_mark", "_first", "_tracked", "_seen", "_next.value as _next", "-_last as _back"
    ).unionByName(
        resets.selectExpr("file_name", "-line as _back", "line as _at_reset"),
        allowMissingColumns=True,
    )
    closed = carry_forward(
        with_resets, ["file_name"], "_back", {"_end": Mark("_at_reset is not null", "_at_reset")}
    ).where("_mark is not null")
    placed = stage(
        closed.selectExpr(
            *keys, "_mark", "_seen", "if(_tracked, least(_next, _end.value), _first) as _close"
        ).selectExpr(
            "*", "_close is null as _open", f"{block_of('coalesce(_close, _seen)')} as _part"
        ),
        "closed_spans",
    )
    part = ["file_name", "_open", "_part"]
    before = "rows between unbounded preceding and 1 preceding"
    counts = placed.groupBy(*part).agg(F.expr("count(*) as _n"))
    files = (
        counts.groupBy("file_name")
        .agg(F.expr("sum(_n) as _n"))
        .selectExpr("file_name", f"coalesce(sum(_n) over (order by file_name {before}), 0L) as _earlier")
    )
    in_file = f"sum(_n) over (partition by file_name order by _open, _part {before})"
    offsets = counts.join(files, "file_name").selectExpr(
        *part, f"_earlier + coalesce({in_file}, 0L) as _offset"
    )
    rank = f"row_number() over (partition by {', '.join(part)} order by _close, _seen, _cursor)"
    return placed.join(offsets, part).selectExpr(
        *keys, "_mark", f"_offset + {rank} as span_id"
    )


LINE_BITS = 36  # of 63; the others number files


def first_lines(segmented: DataFrame) -> DataFrame:
    """``file_name, _cursor, _mark, _first_line``: the first call of spans whose mark is no call of their own.

    All cursors that go on after a reset line have that line as their mark, and those at the start of a file
    have none; every other mark is the span's first call itself.
    """
    shared = segmented.where(f"{_TRACKED} and coalesce(_reset, 0L) > coalesce(_pic, -1L)")
    return shared.groupBy(
        "file_name", F.expr("coalesce(cursor_id, '') as _cursor"), F.expr("coalesce(_reset, 0L) as _mark")
    ).agg(F.expr("min(line) as _first_line"))


def _unique_ids(cut: DataFrame, segmented: DataFrame, numbers: DataFrame) -> DataFrame:
    """File number in the high bits, line of the span's first call in the low ones."""
    keys = ["file_name", "_cursor", "_mark"]
    line = "coalesce(_first_line, _mark)"
    fits = f"file_number < {1 << 63 - LINE_BITS}L and {line} < {1 << LINE_BITS}L"
    made = f"""if({fits}, shiftleft(file_number, {LINE_BITS}) | {line},
        raise_error('too many files or lines for unique ids')) as span_id"""
    kept = [c for c in cut.columns if c != "span_id"]
    return cut.join(first_lines(segmented), keys, "left").join(numbers, "file_name").selectExpr(*kept, made)


def number_spans(
    cut: DataFrame,
    ids: str = "hash",
    resets: DataFrame | None = None,
    segmented: DataFrame | None = None,
    numbers: DataFrame | None = None,
) -> DataFrame:
    """Turn (file, cursor, mark) into ``span_id``.

    ``hash``: a 64-bit hash, stable over runs and independent of other files; two spans may share one.
    ``unique``: number of the file and line of the span's first call; ``segmented`` are the rows that
    ``cut`` was made from, ``numbers`` those of the files. ``dense``: numbers from 1 in the order of
    closing; needs the reset lines.
    """
    if ids == "hash":
        return cut.withColumn("span_id", F.xxhash64("file_name", "_cursor", "_mark"))
    if ids == "unique":
        if segmented is None or numbers is None:
            raise ValueError("unique ids need the segmented rows and the numbers of the files")
        return _unique_ids(cut, segmented, numbers)
    if ids != "dense":
        raise ValueError(f"ids must be 'hash', 'unique' or 'dense', not {ids!r}")
    if resets is None:
        raise ValueError("dense ids need the reset lines")
    numbered = _dense_ids(cut, resets)
    return cut.drop("span_id").join(numbered, ["file_name", "_cursor", "_mark"])


def assign_spans(
    ops: DataFrame, ids: str = "hash", attach_lobs: bool = False, numbers: DataFrame | None = None
) -> DataFrame:
    """Add ``span_id`` and the resolved ``sql_id`` to the records of trace files.

    ``ops`` has ``file_name, line, cursor_id, ops, sql_id`` and rows with op RESET for reset lines.
    Intermediate tables are staged; the input itself is read a few times, so stage it as well if it
    is expensive.
    """
    segmented = stage(segment_calls(ops), "segments")
    cut = cut_spans(segmented, stage(repeated_starts(segmented), "starts"), attach_lobs)
    resets = ops.where("ops = 'RESET'").select("file_name", "line")
    if ids == "unique" and numbers is None:
        numbers = number_files(segmented)
    return number_spans(cut, ids, resets, segmented, numbers).drop("_cursor", "_mark")


def span_op_counts(ops: DataFrame, across_files: bool = False) -> DataFrame:
    """Calls of each kind per span, and their number. Unless spans go ``across_files``, those of two files
    stay apart even if their ids are equal."""
    kinds = [*TRACKED_OPS, "LOB", "XCTEND", "STAR", "HEADER"]
    return ops.groupBy(*(["span_id"] if across_files else ["file_name", "span_id"])).agg(
        *[
            F.expr(
                f"count_if({'startswith(ops, ' + repr(k) + ')' if k == 'LOB' else 'ops = ' + repr(k)})"
                f" as n_{k.lower().replace(' ', '_')}"
            )
            for k in kinds
        ],
        F.expr("count(*) as n_ops"),
    ).drop("file_name")
