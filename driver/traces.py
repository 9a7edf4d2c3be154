"""Registered queries over trace text, each with its DuckDB counterpart where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver.views import DUCK_OPS, DUCK_TRACE, ops_view, trace_view
from spanloom.functions import trace_text as X
from spanloom.operators.classify import assemble, classify
from spanloom.operators.clock import assign_clock
from spanloom.operators.context import CONTEXT, fill_context
from spanloom.operators.parse import parse_records
from spanloom.operators.render import render_line
from spanloom.operators.spans import assign_spans, resolve_sql_id, span_op_counts, validate
from spanloom.plans.export import export_events, export_spans
from spanloom.plans.ingest import ingest, ingest_stats
from spanloom.schema import OPS_SCHEMA
from spanloom.sources.stage import stage, stage_path
from spanloom.sources.store import RELATIONAL_NAMES, jdbc_rows, read_ops, write_ops
from spanloom.sources.trace import read_lines
from spanloom.streaming.follow import follow
from spanloom.streaming.ingest import stream_ingest

_CALL = X.CALL

# Lines with their kind and owner, by plain windows over each file.
_LINES = rf"""with trace as ({DUCK_TRACE}),
a as (select *, regexp_extract(value, '{_CALL}', 1) as call from trace where line > 3 and length(value) > 0),
b as (select *,
  last_value(case when call <> '' then call end ignore nulls) over w as owner_op,
  last_value(case when call <> '' then line end ignore nulls) over w as owner_line,
  coalesce(last_value(case when value like 'END OF STMT%' then line end ignore nulls)
    over (partition by file_name order by line rows between unbounded preceding and 1 preceding), 0) as end_line
  from a window w as (partition by file_name order by line)),
c as (select file_name, line, value, call, owner_line, case
  when call <> '' then 'CALL'
  when owner_op = 'BINDS' and value like ' %' then 'TEXT'
  when owner_op = 'PARSE ERROR' then 'TEXT'
  when owner_op = 'PARSING IN CURSOR' and end_line < owner_line and value like 'END OF STMT%' then 'END'
  when owner_op = 'PARSING IN CURSOR' and end_line < owner_line then 'TEXT'
  when regexp_matches(value, '^XCTEND:* ') then 'XCTEND'
  when regexp_matches(value, '^LOB[A-Z]+:* ') then 'LOB'
  when value like '=====================%' then 'RESET'
  when regexp_matches(value, '^\*{{3}} \d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{{6}}[+-]\d\d:\d\d') then 'STAR'
  when regexp_matches(value, '^\*\*\* (CLIENT ID|MODULE NAME|ACTION NAME|SERVICE NAME|SESSION ID|CONTAINER ID):\(.*\) ') then 'STAR'
  when regexp_matches(value, '^Node name:\s+') then 'HEADER'
  else 'ORPHAN' end as kind from b),
d as (select *, case when kind = 'CALL' then replace(call, 'PARSING IN CURSOR', 'PIC')
    when kind in ('LOB', 'XCTEND') then regexp_extract(value, '^(LOB[A-Z]+|XCTEND):* (.*)', 1) else kind end as ops,
  case when kind = 'CALL' then regexp_extract(value, '{_CALL}', 2) end as cursor_id,
  case when kind = 'CALL' then regexp_extract(value, '{_CALL}', 3)
    when kind in ('LOB', 'XCTEND') then regexp_extract(value, '^(LOB[A-Z]+|XCTEND):* (.*)', 2) end as params
  from c where kind not in ('TEXT', 'END')),
t as (select file_name, owner_line as line, string_agg(value || chr(10), '' order by line) as text from c where kind = 'TEXT' group by all)
"""


def _int(key: str, sep: str = ",", kind: str = "bigint") -> str:
    found = rf"regexp_extract(params, '(?:^|{sep} ?){key}=(\d+)(?:{sep}|$)', 1)"
    return f"coalesce(try_cast({found} as {kind}), 0)::{kind}"


def _tim(sep: str = ",") -> str:
    return f"nullif({_int('tim', sep)}, 0)"


_SHORT = "(cursor_id <> '#0' and length(cursor_id) <= 2)"
_BAD = rf"""(ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE') and not regexp_matches(params, '^\w+=\d+(,\w+=\d+)*$')
  or ops = 'XCTEND' and not regexp_matches(params, '^\w+=\d+(, \w+=\d+)*$')
  or kind = 'LOB' and not regexp_matches(params, '^type=[^,=]*(,\w+=\d+)*$'))"""
_GOOD = f"coalesce(not {_SHORT}, true) and not {_BAD}"
_STAR_TS = r"""(case when regexp_matches(stamp, '[+-]\d\d:\d\d$') then substr(stamp, 1, 26)::timestamp
  - (case when substr(stamp, 27, 1) = '-' then -1 else 1 end) * (substr(stamp, 28, 2)::int * interval 1 hour + substr(stamp, 31, 2)::int * interval 1 minute)
  else stamp::timestamp end)"""
_STARS = rf"""stars as (select file_name, line, case when n = '' then 'DATETIME' else n end as event_name,
    case when n <> '' then trim(v, '()') end as event_raw, {_STAR_TS} as ts
  from (select *, regexp_extract(value, '(\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{{6}}([+-]\d\d:\d\d)?)', 1) as stamp,
    regexp_extract(value, '^\*\*\* ([A-Z ]+):(\(.*\)) ', 1) as n, regexp_extract(value, '^\*\*\* ([A-Z ]+):(\(.*\)) ', 2) as v
    from d where kind = 'STAR'))"""
_WAIT = r"^ nam='(.*)' ela= (\d+) (.*) tim=(\d+)"
_WAIT_SQL = _WAIT.replace("'", "''")


def _ref(name: str, kind: str = "bigint") -> str:
    return f"{name}::{kind} as {name}"


# The stored records with the columns the ordered operators need.
_RECORDS = rf"""{_LINES}, {_STARS},
rec as (select d.file_name, d.line, d.kind, d.ops, d.cursor_id,
  case when ops = 'PIC' then regexp_extract(params, 'sqlid=''([^'']*)''', 1) end as sql_id,
  case when ops = 'WAIT' then nullif(coalesce(try_cast(regexp_extract(params, '{_WAIT_SQL}', 4) as bigint), 0), 0)
    when ops in ('PIC', 'ERROR', 'PARSE ERROR') then nullif(coalesce(try_cast(regexp_extract(params, '(?:^| )tim=(\d+)(?: |$)', 1) as bigint), 0), 0)
    when ops = 'XCTEND' then nullif(coalesce(try_cast(regexp_extract(params, 'tim=(\d+)$', 1) as bigint), 0), 0)
    when kind in ('CALL', 'LOB') then {_tim()} end as tim,
  stars.event_name, stars.event_raw, stars.ts
  from d left join stars on d.file_name = stars.file_name and d.line = stars.line
  where kind <> 'ORPHAN' and {_GOOD})"""

# Spans by recursion: per cursor, rows in line order; the state is the set of calls seen so far.
_SPANS = rf"""{_RECORDS.replace('with trace', 'with recursive trace', 1)},
res as (select *, coalesce(max(case when ops = 'RESET' then line end) over (partition by file_name order by line), 0) as reset_at,
  last_value(case when ops = 'PIC' then sql_id end ignore nulls) over (partition by file_name, cursor_id order by line) as cursor_sql from rec),
trk as (select *, row_number() over (partition by file_name, cursor_id order by line) as rn,
    list_position(['PARSE', 'EXEC', 'CLOSE', 'BINDS', 'ERROR', 'PARSE ERROR'], ops) as once
  from res where kind = 'CALL'),
walk as (
  select file_name, cursor_id, line, rn, ops, cursor_sql, reset_at, case when once > 0 then (1 << (once - 1)::int) else 0 end as seen, line as first_line
  from trk where rn = 1
  union all
  select t.file_name, t.cursor_id, t.line, t.rn, t.ops, t.cursor_sql, t.reset_at,
    case when t.ops = 'PIC' or t.reset_at <> w.reset_at or (t.once > 0 and (w.seen & (1 << (t.once - 1)::int)) <> 0)
      then case when t.once > 0 then (1 << (t.once - 1)::int) else 0 end
      else w.seen | case when t.once > 0 then (1 << (t.once - 1)::int) else 0 end end,
    case when t.ops = 'PIC' or t.reset_at <> w.reset_at or (t.once > 0 and (w.seen & (1 << (t.once - 1)::int)) <> 0)
      then t.line else w.first_line end
  from walk w join trk t on t.file_name = w.file_name and t.cursor_id = w.cursor_id and t.rn = w.rn + 1),
spn as (select file_name, line, ops, cursor_id, cursor_id as span_cursor, cursor_sql as sql_id, first_line from walk
  union all select file_name, line, ops, null, '', null, line from rec where kind in ('XCTEND', 'LOB', 'STAR', 'HEADER'))"""

_SPAN_ROWS = """select file_name, min(line) as first_line, max(line) as last_line, count(*) as n_ops,
  max(cursor_id) as cursor_id, max(sql_id) as sql_id from {src} group by file_name, span_cursor, first_line"""

_CLOCK = rf"""{_RECORDS},
anc as (select *, last_value(case when ops = 'STAR' and ts is not null then line end ignore nulls) over w as anchor_line,
    last_value(case when ops = 'STAR' then ts end ignore nulls) over w as anchor_ts,
    last_value(case when tim is not null then line end ignore nulls) over w as timed_line,
    last_value(tim ignore nulls) over w as timed_tim
  from rec window w as (partition by file_name order by line)),
fst as (select file_name, anchor_line, arg_min(tim, line) as first_tim from anc where tim is not null and anchor_line is not null group by all)
select anc.file_name, anc.line, anc.ops, case when ops in ('STAR', 'HEADER') then ts
    when timed_line > anc.anchor_line then anchor_ts + to_microseconds(timed_tim - first_tim) else anchor_ts end as ts
from anc left join fst on anc.file_name = fst.file_name and anc.anchor_line = fst.anchor_line where ops <> 'RESET'"""


def _parsed(spark, sf_dir: str) -> DataFrame:
    return parse_records(assemble(stage(classify(trace_view(spark, sf_dir)), "lines")))


def _stored(spark, sf_dir: str) -> DataFrame:
    """Accepted records as a staged table, the input of the ordered operators."""
    parsed = _parsed(spark, sf_dir).where("reject is null and kind <> 'ORPHAN'")
    return stage(parsed.drop("kind", "value", "reject"), "stored")


def _kind(spark, sf_dir: str, condition: str, *columns: str) -> DataFrame:
    return _parsed(spark, sf_dir).where(f"reject is null and {condition}").selectExpr(
        "file_name", "line", *columns
    )


def _per_span(ops: DataFrame) -> DataFrame:
    """Comparable form of a span assignment that does not depend on the ids."""
    return ops.groupBy("file_name", "span_id").agg(
        F.min("line").alias("first_line"),
        F.max("line").alias("last_line"),
        F.count("*").alias("n_ops"),
        F.max("cursor_id").alias("cursor_id"),
        F.max("sql_id").alias("sql_id"),
    ).drop("span_id")


def _written_trace(spark, sf_dir: str) -> tuple[str, DataFrame]:
    """Trace text as files: a thousand events each, so the number of files grows with the data."""
    lines = trace_view(spark, sf_dir).withColumn("part", F.expr("(line - 4) div 8000"))
    path = stage_path(spark, "trace_text")
    (
        lines.repartition("part")
        .sortWithinPartitions("part", "line")
        .select("part", "value")
        .write.partitionBy("part")
        .text(path)
    )
    return path, lines


_CALL_INTS = [("cpu_time", "c", "bigint"), ("elapsed_time", "e", "bigint"), ("ph_reads", "p", "bigint"),
              ("cr_reads", "cr", "bigint"), ("current_reads", "cu", "bigint"), ("cursor_missed", "mis", "integer"),
              ("rows_processed", "r", "bigint"), ("rec_call_dp", "dep", "integer"), ("opt_goal", "og", "integer"),
              ("plh", "plh", "bigint"), ("c_type", "type", "integer")]
_PIC_INTS = [("len", "len", "bigint"), ("rec_call_dp", "dep", "integer"), ("uid", "uid", "bigint"),
             ("oct", "oct", "integer"), ("lid", "lid", "integer"), ("hv", "hv", "bigint")]
_ERR_INTS = [("error_code", "err", "integer"), *_PIC_INTS[:5]]
_LOB_INTS = [("bytes", "bytes", "bigint"), *_CALL_INTS[:5]]


def _ints(columns, sep: str) -> str:
    return ", ".join(f"{_int(key, sep, kind)} as {name}" for name, key, kind in columns)


_RENDERED = r"""case when ops in ('WAIT', 'STAT', 'BINDS') then cursor_id || ': ' || ops || ' ' || params || case when ops = 'BINDS' then coalesce(text, '') else '' end
  when ops = 'ERROR' then 'ERROR ' || cursor_id || ':err=' || {err} || ' tim=' || coalesce({tim}, 0)
  when ops = 'XCTEND' then 'XCTEND rlbk=' || {rlbk} || ', rd_only=' || {rdo} || ', tim=' || coalesce({ctim}, 0)
  when ops = 'HEADER' then 'Node name: ' || regexp_extract(value, '^Node name:\s+(.*)', 1) end""".format(
    err=_int("err", " ", "integer"), tim=_tim(" "), rlbk=_int("rlbk", ",", "integer"),
    rdo=_int("rd_only", ",", "integer"), ctim=_tim(),
)


def _read_back_lines(spark, sf_dir: str) -> DataFrame:
    path, _ = _written_trace(spark, sf_dir)
    part = F.regexp_extract("file_name", r"part=(\d+)/", 1).cast("bigint")
    return read_lines(spark, path).select(part.alias("part"), "line", "value")


def _streamed(spark, sf_dir: str) -> str:
    path, _ = _written_trace(spark, sf_dir)
    out = stage_path(spark, "stream_out")
    stream_ingest(spark, f"{path}/*", out, stage_path(spark, "stream_state")).awaitTermination()
    return out


def _stream(spark, sf_dir: str) -> DataFrame:
    return read_ops(spark, _streamed(spark, sf_dir)).groupBy("ops").agg(
        F.count("*").alias("n"), F.sum("elapsed_time").alias("elapsed_time"), F.count("tim").alias("timed")
    )


def _stream_rejects(spark, sf_dir: str) -> DataFrame:
    """Lines that a stream did not store, by the number of their file."""
    out, file = _streamed(spark, sf_dir), F.regexp_extract("file_name", r"part=(\d+)/", 1).cast("bigint")
    rejects, orphans = (spark.read.parquet(f"{out}/{table}") for table in ("_rejects", "_orphans"))
    return rejects.select(file.alias("part"), "line", "value", "reason").unionByName(
        orphans.select(file.alias("part"), "line", "value", F.lit("orphan").alias("reason"))
    )


def _round_trip(spark, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "ops")
    write_ops(ops_view(spark, sf_dir), path)
    return read_ops(spark, path)


# The same text cut into files of 8000 line numbers, renumbered; then counted by kind of record.
_FILE_LINES = _LINES.replace("with trace as (", "with trace0 as (", 1).replace(
    "\na as (",
    """
trace as (select 'f' || ((line - 4) // 8000) as file_name,
  row_number() over (partition by (line - 4) // 8000 order by line) as line, value from trace0),
a as (""",
    1,
)
_FILES_SQL = (
    _FILE_LINES
    + rf""" select ops, count(*) as n,
  cast(sum(case when ops = 'WAIT' then coalesce(try_cast(regexp_extract(params, '{_WAIT_SQL}', 2) as bigint), 0)
    when ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE') or kind = 'LOB' then {_int('e')} else 0 end) as bigint) as elapsed_time,
  count(case when ops = 'WAIT' then try_cast(regexp_extract(params, '{_WAIT_SQL}', 4) as bigint)
    when ops in ('PIC', 'ERROR', 'PARSE ERROR') then try_cast(regexp_extract(params, '(?:^| )tim=(\d+)(?: |$)', 1) as bigint)
    when ops = 'XCTEND' then try_cast(regexp_extract(params, 'tim=(\d+)$', 1) as bigint)
    when kind in ('CALL', 'LOB') then {_tim()} end) as timed
  from d where kind not in ('ORPHAN', 'RESET') and {_GOOD} group by ops"""
)


# Attributes of an event that its row does not name anyway, and a view where some records are no events.
_ATTRIBUTES = [
    "cursor_id", "tim", "elapsed_time", "cpu_time", "ph_reads", "cr_reads", "current_reads", "rows_processed",
    "event_name", "event_raw", "file_name", "client_id",
]
_KIND = "case when line % 17 = 0 then 'STAR' when line % 19 = 0 then 'HEADER' else ops end as ops"
_WITH_STARS = f"with v as ({DUCK_OPS}), w as (select v.* exclude (ops), {_KIND} from v)"


_STREAM_REJECTS_SQL = f"""{_FILE_LINES} select case when kind = 'ORPHAN' then 'orphan' when {_BAD} then 'params' else 'cursor' end as reason,
  value, count(*) as n from d where kind = 'ORPHAN' or not ({_GOOD}) group by all"""


def _with_stars(spark, sf_dir: str) -> DataFrame:
    return ops_view(spark, sf_dir).withColumn("ops", F.expr(_KIND.removesuffix(" as ops")))


_CONTEXT_SQL = ", ".join(
    f"last_value(case when event_name = '{name}' then event_raw{'::integer' if column == 'container_id' else ''} end "
    f"ignore nulls) over w as {column}"
    for column, name in CONTEXT.items()
)
# All columns of the fact table from the view, NULL where the view has none.
_DUCK_TYPES = {"bigint": "bigint", "int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}
_VIEWED = {
    "span_id", "sql_id", "cursor_id", "ops", "cpu_time", "elapsed_time", "ph_reads", "cr_reads", "current_reads",
    "rows_processed", "tim", "event_name", "event_raw", "file_name", "line", "ts", "client_id",
}


def _all_columns(named: dict[str, str], only: set[str], names: dict[str, str]) -> str:
    kinds = {f.name: _DUCK_TYPES[f.dataType.simpleString()] for f in OPS_SCHEMA.fields}
    value = {c: named.get(c, c) if c in only else "null" for c in kinds}
    return ", ".join(f"cast({value[c]} as {kind}) as {names.get(c, c)}" for c, kind in kinds.items())


def _key_values(columns, sep: str, tim_sep: str | None = None, **more: str) -> str:
    """SQL of ``key=value`` pairs: integers of the record, its clock, and further values by key."""
    parts = [f"'{key}=' || {_int(key, tim_sep or sep, kind)}" for _, key, kind in columns]
    parts += [f"'{key}=' || {value}" for key, value in more.items()]
    return f" || '{sep}' || ".join(parts)


_AD, _SQLID = (f"regexp_extract(params, '{key}=''([^'']*)''', 1)" for key in (" ad", "sqlid"))
_TIM0, _TIM0_SPACE = f"coalesce({_tim()}, 0)", f"coalesce({_tim(' ')}, 0)"
# The kinds that render_line's query leaves out, from the column lists of their parse queries.
_RENDERED_OTHERS = rf"""case when d.ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE') then cursor_id || ': ' || d.ops || ' '
    || {_key_values(_CALL_INTS[:-1], ",", tim=_TIM0, fname="d.file_name", line="d.line")}
  when d.ops = 'PIC' then 'PARSING IN CURSOR ' || {_key_values(_PIC_INTS[:5], " ", tim=_TIM0_SPACE)} || ' '
    || {_key_values(_PIC_INTS[5:], " ", ad=_AD, sqlid=_SQLID)}
    || chr(10) || coalesce(text, '') || chr(10) || 'END OF STMT'
  when d.ops = 'PARSE ERROR' then 'PARSE ERROR ' || cursor_id || ':'
    || {_key_values(_ERR_INTS[1:], " ", tim=_TIM0_SPACE, err=_int("err", " ", "integer"))}
  when kind = 'STAR' then '*** ' || stars.event_name || ':(' || coalesce(stars.event_raw, '') || ') '
    || coalesce(regexp_replace(strftime(stars.ts, '%Y-%m-%d %H:%M:%S.%f'), '\.?0*$', ''), '')
  when kind = 'LOB' then d.ops || ': type=' || regexp_extract(params, '^type=([^,]*)', 1) || ','
    || {_key_values(_LOB_INTS, ",", tim=_TIM0)} end"""
_OTHERS = "(d.ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE', 'PIC', 'PARSE ERROR') or kind in ('STAR', 'LOB'))"


# The integers of a record: those of its kind's list, and 0 for all others.
_INT_LISTS = [
    ("d.ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE')", ",", _CALL_INTS),
    ("d.kind = 'LOB'", ",", _LOB_INTS),
    ("d.ops = 'PIC'", " ", _PIC_INTS),
    ("d.ops in ('ERROR', 'PARSE ERROR')", " ", _ERR_INTS),
    ("d.ops = 'XCTEND'", ",", [("rlbk", "rlbk", "integer"), ("rd_only", "rd_only", "integer")]),
    ("d.ops = 'WAIT'", "", [("elapsed_time", None, "bigint")]),
]
_WAITED = f"coalesce(try_cast(regexp_extract(params, '{_WAIT_SQL}', 2) as bigint), 0)"


def _listed(column: str) -> str:
    cases = [
        f"when {when} then {_int(key, sep, kind) if key else _WAITED}"
        for when, sep, columns in _INT_LISTS
        for name, key, kind in columns
        if name == column
    ]
    return f"case {' '.join(cases)} else 0 end"


_ROW_TEXTS = {
    "event_name": rf"""case when d.ops = 'WAIT' then regexp_extract(params, '{_WAIT_SQL}', 1) when d.kind = 'STAR' then stars.event_name
      when d.kind = 'HEADER' then 'Node name' else '' end""",
    "event_raw": r"""case when d.ops in ('WAIT', 'STAT') then params when d.ops = 'BINDS' then params || coalesce(text, '')
      when d.ops in ('PIC', 'PARSE ERROR') then coalesce(text, '') when d.kind = 'STAR' then stars.event_raw
      when d.kind = 'HEADER' then regexp_extract(value, '^Node name:\s+(.*)', 1) else '' end""",
    "ad": f"case when d.ops = 'PIC' then {_AD} else '' end",
    "lobtype": "case when d.kind = 'LOB' then regexp_extract(params, '^type=([^,]*)', 1) else '' end",
}
_ROW = {
    "span_id": "number * (1::bigint << 36) + first_line", "sql_id": "n.sql_id", "cursor_id": "n.cursor_id", "ops": "n.ops", "tim": "rec.tim",
    "file_name": "n.file_name", "line": "n.line", "ts": "clk.ts", **_ROW_TEXTS, **{c: f"ctx.{c}" for c in CONTEXT},
}
_ROWS_SQL = f"""{_SPANS}, n as (select *, dense_rank() over (order by file_name) - 1 as number from spn),
ctx as (select file_name, line, {_CONTEXT_SQL} from rec window w as (partition by file_name order by line)),
clk as (with anc as {_CLOCK.split("anc as", 1)[1]})
select {", ".join(f"cast({_ROW.get(f.name) or _listed(f.name)} as {_DUCK_TYPES[f.dataType.simpleString()]}) as {f.name}" for f in OPS_SCHEMA.fields)}
from n join d on n.file_name = d.file_name and n.line = d.line join rec on n.file_name = rec.file_name and n.line = rec.line
  join ctx on n.file_name = ctx.file_name and n.line = ctx.line join clk on n.file_name = clk.file_name and n.line = clk.line
  left join t on n.file_name = t.file_name and n.line = t.line left join stars on n.file_name = stars.file_name and n.line = stars.line"""


def _dense(ops: DataFrame) -> DataFrame:
    """Each span with its dense number."""
    return ops.groupBy("file_name", "span_id").agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"))


# Trace files of 800 line numbers each; all files of a server are written by one process.
_PIECE_NAME = "concat(file_name, '.', cast((line - 4) {div} 800 as {S})) as file_name"
_PIECE_LINE = "(line - 4) % 800 + 4 as line"
_PROCESS = "regexp_extract(file_name, '(.*)[.]', 1)"
_PIECE_RECORDS = _RECORDS.replace("with trace as (", "with recursive trace0 as (", 1).replace(
    "\na as (", f"\ntrace as (select {_PIECE_NAME.format(div='//', S='varchar')}, {_PIECE_LINE}, value from trace0),\na as (", 1
).replace("\nrec as (", "\nrec0 as (", 1)
# The records of a process as one file: files by their first wall clock, then name.
_OF_PROCESS = _PROCESS.replace("file_name", "rec0.file_name")
_SEQUENCE_SQL = f"""{_PIECE_RECORDS},
pl as (select file_name, arg_min(ts, line) filter (where ops = 'STAR' and ts is not null) as since from rec0 group by file_name),
rec as (select {_OF_PROCESS} as file_name, rec0.* exclude (file_name, line), rec0.file_name as own_file, line as own_line,
    row_number() over (partition by {_OF_PROCESS} order by since is null, since, rec0.file_name, line) as line
  from rec0 join pl on rec0.file_name = pl.file_name),
res as ({_SPANS.split("res as (", 1)[1]}, clk as (with anc as {_CLOCK.split("anc as", 1)[1]})
select count(*) as n_ops, count(distinct own_file) as files, min(own_file) as first_file, max(own_file) as last_file,
  cast(sum(own_line) as bigint) as lines, max(spn.sql_id) as sql_id, min(clk.ts) as first_ts, max(clk.ts) as last_ts
from spn join clk on spn.file_name = clk.file_name and spn.line = clk.line
  join rec on spn.file_name = rec.file_name and spn.line = rec.line
group by spn.file_name, span_cursor, first_line"""


def _sequence(spark, sf_dir: str) -> DataFrame:
    """Spans of processes whose trace is cut into many files; what they hold, without their ids."""
    pieces = trace_view(spark, sf_dir).selectExpr(_PIECE_NAME.format(div="div", S="string"), _PIECE_LINE, "value")
    ops = ingest(pieces, ids="unique", stream_key=_PROCESS).ops
    return ops.groupBy("span_id").agg(
        F.count("*").alias("n_ops"),
        F.count_distinct("file_name").alias("files"),
        F.min("file_name").alias("first_file"),
        F.max("file_name").alias("last_file"),
        F.sum("line").alias("lines"),
        F.max("sql_id").alias("sql_id"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ).drop("span_id")


def _followed(spark, sf_dir: str) -> DataFrame:
    """Spans of files that grow in two rounds and end in a third; each round writes the files anew, with more of their lines."""
    out, state = stage_path(spark, "followed"), stage_path(spark, "follow_state")
    lines = trace_view(spark, sf_dir).withColumn("part", F.expr("(line - 4) div 8000"))
    for most in (4000, 8000):
        path = stage_path(spark, "growing_text")
        some = lines.where(F.expr(f"(line - 4) % 8000 < {most}"))
        some.repartition("part").sortWithinPartitions("part", "line").select("part", "value").write.partitionBy("part").text(path)
        follow(spark, f"{path}/*", out, state, name=r"concat('f', regexp_extract(file_name, 'part=(\\d+)', 1))")
    follow(spark, f"{path}/*", out, state, name=r"concat('f', regexp_extract(file_name, 'part=(\\d+)', 1))", idle_rounds=1)
    return _per_span(read_ops(spark, out))


_FOLLOWED_SQL = _SPANS.replace("with recursive trace as (", "with recursive trace0 as (", 1).replace(
    "\na as (",
    """
trace as (select 'f' || ((line - 4) // 8000) as file_name,
  row_number() over (partition by (line - 4) // 8000 order by line) as line, value from trace0),
a as (""",
    1,
) + _SPAN_ROWS.format(src="spn")


def _totals(spark, sf_dir: str) -> DataFrame:
    """Totals of an ingest, and of the batches of a stream of the same text in files of a thousand events."""
    whole = ingest(trace_view(spark, sf_dir)).totals
    counts = ("lines", "records", "rejects", "orphans")
    one = spark.createDataFrame([("batch", *[getattr(whole, c) for c in counts])], f"way string, {' bigint, '.join(counts)} bigint")
    batches = spark.read.parquet(f"{_streamed(spark, sf_dir)}/_totals")
    return one.unionByName(batches.select(F.lit("stream").alias("way"), *[F.sum(c).alias(c) for c in counts]))


def _totals_sql(lines: str, way: str) -> str:
    return f"""(with l as (select * from ({lines} select kind, {_BAD} as bad, {_GOOD} as good from d) x) select '{way}' as way,
      count_if(kind <> 'ORPHAN' and kind <> 'RESET' and good) as records, count_if(kind <> 'ORPHAN' and not good) as rejects,
      count_if(kind = 'ORPHAN') as orphans from l)"""


_TOTALS_SQL = f"""select *, (select count(*) from ({DUCK_TRACE})) as lines from (
  select * from {_totals_sql(_LINES, "batch")} union all select * from {_totals_sql(_FILE_LINES, "stream")})"""


def _rejects(spark, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).where("reject is not null")


TRACE_QUERIES = {
    "classify_lines": (
        lambda s, d: classify(trace_view(s, d)).select("file_name", "line", "kind", "owner"),
        f"{_LINES} select file_name, line, kind, case when kind = 'TEXT' then owner_line end as owner from c",
    ),
    "assemble_records": (
        lambda s, d: assemble(classify(trace_view(s, d))).select(
            "file_name", "line", "kind", "value", F.coalesce("text", F.lit("")).alias("text")
        ),
        f"""{_LINES} select d.file_name, d.line, kind, value, coalesce(text, '') as text
        from d left join t on d.file_name = t.file_name and d.line = t.line""",
    ),
    "parse_calls": (
        lambda s, d: _kind(
            s, d, "ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE')", "ops", "cursor_id", "tim", *[c[0] for c in _CALL_INTS]
        ),
        f"""{_LINES} select file_name, line, ops, cursor_id, {_tim()} as tim, {_ints(_CALL_INTS, ',')} from d
        where ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE') and {_GOOD}""",
    ),
    "parse_waits": (
        lambda s, d: _kind(s, d, "ops = 'WAIT'", "cursor_id", "event_name", "elapsed_time", "tim", "event_raw"),
        rf"""{_LINES} select file_name, line, cursor_id, regexp_extract(params, '{_WAIT_SQL}', 1) as event_name,
        coalesce(try_cast(regexp_extract(params, '{_WAIT_SQL}', 2) as bigint), 0) as elapsed_time,
        try_cast(regexp_extract(params, '{_WAIT_SQL}', 4) as bigint) as tim, params as event_raw
        from d where ops = 'WAIT' and {_GOOD}""",
    ),
    "parse_pic": (
        lambda s, d: _kind(
            s, d, "ops = 'PIC'", "cursor_id", "sql_id", "ad", "tim", "event_raw", *[c[0] for c in _PIC_INTS]
        ),
        rf"""{_LINES} select d.file_name, d.line, cursor_id, regexp_extract(params, 'sqlid=''([^'']*)''', 1) as sql_id,
        regexp_extract(params, ' ad=''([^'']*)''', 1) as ad, {_tim(' ')} as tim, text as event_raw, {_ints(_PIC_INTS, ' ')}
        from d left join t on d.file_name = t.file_name and d.line = t.line where ops = 'PIC' and {_GOOD}""",
    ),
    "parse_errors": (
        lambda s, d: _kind(
            s, d, "ops in ('ERROR', 'PARSE ERROR')", "ops", "cursor_id", "tim", "event_raw", *[c[0] for c in _ERR_INTS]
        ),
        f"""{_LINES} select d.file_name, d.line, ops, cursor_id, {_tim(' ')} as tim, coalesce(text, '') as event_raw, {_ints(_ERR_INTS, ' ')}
        from d left join t on d.file_name = t.file_name and d.line = t.line where ops in ('ERROR', 'PARSE ERROR') and {_GOOD}""",
    ),
    "parse_xctend": (
        lambda s, d: _kind(s, d, "ops = 'XCTEND'", "rlbk", "rd_only", "tim"),
        f"""{_LINES} select file_name, line, {_int('rlbk', ',', 'integer')} as rlbk, {_int('rd_only', ',', 'integer')} as rd_only,
        {_tim()} as tim from d where ops = 'XCTEND' and {_GOOD}""",
    ),
    "parse_lobs": (
        lambda s, d: _kind(s, d, "kind = 'LOB'", "ops", "lobtype", "tim", *[c[0] for c in _LOB_INTS]),
        f"""{_LINES} select file_name, line, ops, regexp_extract(params, '^type=([^,]*)', 1) as lobtype, {_tim()} as tim,
        {_ints(_LOB_INTS, ',')} from d where kind = 'LOB' and {_GOOD}""",
    ),
    "parse_raw": (
        lambda s, d: _kind(s, d, "ops in ('STAT', 'BINDS')", "ops", "cursor_id", "event_raw"),
        f"""{_LINES} select d.file_name, d.line, ops, cursor_id, params || case when ops = 'BINDS' then coalesce(text, '') else '' end as event_raw
        from d left join t on d.file_name = t.file_name and d.line = t.line where ops in ('STAT', 'BINDS') and {_GOOD}""",
    ),
    "parse_stars": (
        lambda s, d: _kind(s, d, "kind = 'STAR'", "event_name", "event_raw", "ts"),
        f"{_LINES}, {_STARS} select file_name, line, event_name, event_raw, ts from stars",
    ),
    "parse_headers": (
        lambda s, d: _kind(s, d, "kind = 'HEADER'", "event_name", "event_raw"),
        rf"""{_LINES} select file_name, line, 'Node name' as event_name, regexp_extract(value, '^Node name:\s+(.*)', 1) as event_raw
        from d where kind = 'HEADER'""",
    ),
    "rejects": (
        lambda s, d: _rejects(s, d).select("file_name", "line", "value", "reject"),
        f"""{_LINES} select file_name, line, value, case when {_BAD} then 'params' else 'cursor' end as reject
        from d where kind <> 'ORPHAN' and not ({_GOOD})""",
    ),
    "orphans": (
        lambda s, d: _parsed(s, d).where("kind = 'ORPHAN'").select("file_name", "line", "value"),
        f"{_LINES} select file_name, line, value from d where kind = 'ORPHAN'",
    ),
    "validate": (
        lambda s, d: validate(
            assemble(classify(trace_view(s, d))).where("kind = 'CALL'").selectExpr(
                "file_name", "line", "replace(call, 'PARSING IN CURSOR', 'PIC') as ops",
                r"regexp_extract(value, ' (#\\d+)', 1) as cursor_id",
            )
        ).groupBy("ops", "reject").count(),
        f"{_LINES} select ops, case when {_SHORT} then 'cursor' end as reject, count(*) as count from d where kind = 'CALL' group by all",
    ),
    "render_line": (
        lambda s, d: render_line(
            _parsed(s, d).where("reject is null and ops in ('WAIT', 'STAT', 'BINDS', 'ERROR', 'XCTEND', 'HEADER')")
        ).select("file_name", "line", "rendered"),
        f"""{_LINES} select d.file_name, d.line, {_RENDERED} as rendered from d left join t on d.file_name = t.file_name and d.line = t.line
        where ops in ('WAIT', 'STAT', 'BINDS', 'ERROR', 'XCTEND', 'HEADER') and {_GOOD}""",
    ),
    "render_line_others": (
        lambda s, d: render_line(
            _parsed(s, d).where("reject is null and (ops in ('PARSE', 'EXEC', 'FETCH', 'CLOSE', 'PIC', 'PARSE ERROR') or kind in ('STAR', 'LOB'))")
        ).select("file_name", "line", "rendered"),
        f"""{_LINES}, {_STARS} select d.file_name, d.line, {_RENDERED_OTHERS} as rendered from d
        left join t on d.file_name = t.file_name and d.line = t.line
        left join stars on d.file_name = stars.file_name and d.line = stars.line where {_OTHERS} and {_GOOD}""",
    ),
    "fill_context": (
        lambda s, d: fill_context(_stored(s, d)).select(
            "file_name", "line", "ops", *CONTEXT
        ),
        f"""{_RECORDS} select file_name, line, ops,
        {_CONTEXT_SQL} from rec window w as (partition by file_name order by line)""",
    ),
    "resolve_sql_id": (
        lambda s, d: resolve_sql_id(_stored(s, d).where("cursor_id is not null")).select(
            "file_name", "line", "cursor_id", "sql_id"
        ),
        f"""{_RECORDS} select file_name, line, cursor_id,
        last_value(case when ops = 'PIC' then sql_id end ignore nulls) over (partition by file_name, cursor_id order by line) as sql_id
        from rec where cursor_id is not null""",
    ),
    "assign_clock": (
        lambda s, d: assign_clock(_stored(s, d)).where("ops <> 'RESET'").select("file_name", "line", "ops", "ts"),
        _CLOCK,
    ),
    "assign_spans": (
        lambda s, d: _per_span(assign_spans(_stored(s, d))),
        _SPANS + _SPAN_ROWS.format(src="spn"),
    ),
    "assign_spans_dense": (
        lambda s, d: _per_span(assign_spans(_stored(s, d), ids="dense")),
        _SPANS + _SPAN_ROWS.format(src="spn"),
    ),
    "assign_spans_lobs": (
        lambda s, d: _per_span(assign_spans(_stored(s, d), attach_lobs=True)),
        _SPANS
        + """, att as (select *, last_value(case when cursor_id is not null then first_line end ignore nulls) over w as lf,
            last_value(case when cursor_id is not null then span_cursor end ignore nulls) over w as lc,
            last_value(case when cursor_id is not null then sql_id end) over w as ls0 from spn window w as (partition by file_name order by line)),
          prev as (select att.* exclude (ls0), s.sql_id as ls from att left join (select distinct file_name, first_line, span_cursor, sql_id from spn where cursor_id is not null) s
            on s.file_name = att.file_name and s.first_line = lf and s.span_cursor = lc),
          fin as (select file_name, line, cursor_id, case when ops like 'LOB%' and lf is not null then lc else span_cursor end as span_cursor,
            case when ops like 'LOB%' and lf is not null then lf else first_line end as first_line,
            case when ops like 'LOB%' and lf is not null then ls else sql_id end as sql_id from prev) """
        + _SPAN_ROWS.format(src="fin"),
    ),
    "span_op_counts": (
        lambda s, d: span_op_counts(assign_spans(_stored(s, d))).drop("span_id"),
        _SPANS
        + " select "
        + ", ".join(
            f"count(*) filter (where {'ops like ' + repr('LOB%') if k == 'LOB' else 'ops = ' + repr(k)}) as n_{k.lower().replace(' ', '_')}"
            for k in ["PIC", "PARSE", "EXEC", "CLOSE", "BINDS", "ERROR", "PARSE ERROR", "FETCH", "WAIT", "STAT", "LOB", "XCTEND", "STAR", "HEADER"]
        )
        + ", count(*) as n_ops from spn group by file_name, span_cursor, first_line",
    ),
    "ingest": (
        lambda s, d: _per_span(ingest(trace_view(s, d)).ops),
        _SPANS + _SPAN_ROWS.format(src="spn"),
    ),
    "assign_spans_dense_ids": (
        lambda s, d: _dense(assign_spans(_stored(s, d), ids="dense")),
        f"""{_SPANS}, sp as (select file_name, span_cursor, min(line) as lo, max(line) as hi, bool_or(cursor_id is not null) as tracked
            from spn group by file_name, span_cursor, first_line),
          nx as (select *, min(lo) over w as seen, lead(lo) over (w order by lo) as nxt from sp window w as (partition by file_name, span_cursor)),
          cl as (select nx.*, case when tracked then least(nxt, r.line) else lo end as closed from nx
            asof left join (select file_name, line from rec where ops = 'RESET') r on nx.file_name = r.file_name and nx.hi < r.line)
        select row_number() over (order by file_name, closed is null, closed, seen, span_cursor) as span_id, file_name, lo as first_line, hi as last_line from cl""",
    ),
    "ingest_sequence": (
        _sequence,
        _SEQUENCE_SQL,
    ),
    "assign_spans_unique_ids": (
        lambda s, d: _dense(assign_spans(_stored(s, d), ids="unique")),
        f"""{_SPANS}, numbered as (select *, dense_rank() over (order by file_name) - 1 as number from spn)
        select number * (1::bigint << 36) + min(line) as span_id, file_name, min(line) as first_line, max(line) as last_line
        from numbered group by file_name, number, span_cursor, first_line""",
    ),
    "follow_ingest": (
        _followed,
        _FOLLOWED_SQL,
    ),
    "ingest_totals": (
        _totals,
        _TOTALS_SQL,
    ),
    "ingest_rows": (
        lambda s, d: ingest(trace_view(s, d), ids="unique").ops,
        _ROWS_SQL,
    ),
    "ingest_stats": (
        lambda s, d: ingest_stats(trace_view(s, d), _rejects(s, d)),
        f"""{_LINES}, e as (select file_name, count(*) as errors from d where kind <> 'ORPHAN' and not ({_GOOD}) group by file_name)
        select trace.file_name, count(*) as lines, coalesce(any_value(errors), 0) as errors from trace left join e on trace.file_name = e.file_name group by trace.file_name""",
    ),
    "read_lines": (
        _read_back_lines,
        f"""with trace as ({DUCK_TRACE}), p as (select *, (line - 4) // 8000 as part from trace)
        select part, row_number() over (partition by part order by line) as line, value from p""",
    ),
    "export_spans": (
        lambda s, d: export_spans(_with_stars(s, d)),
        f"""{_WITH_STARS} select span_id, file_name, arg_min(client_id, line) as trace_id,
        nullif(arg_min(coalesce(sql_id, ''), line), '') as name, epoch_us(arg_min(ts, line)) * 1000 as start_ns,
        epoch_us(arg_max(ts, line)) * 1000 as end_ns, min(line) as first_line, count(*) as n_events
        from w where ops not in ('STAR', 'HEADER') group by span_id, file_name""",
    ),
    "export_events": (
        lambda s, d: export_events(_with_stars(s, d), "client_id").select(
            "span_id", "trace_id", "sql_id", "line", "time_ns", "name", *[f"attributes.{c}" for c in _ATTRIBUTES]
        ),
        f"""{_WITH_STARS} select span_id, client_id as trace_id, sql_id, line, epoch_us(ts) * 1000 as time_ns,
        case when ops = 'PIC' then 'PARSING IN CURSOR' else ops end as name, {", ".join(_ATTRIBUTES)}
        from w where ops not in ('STAR', 'HEADER')""",
    ),
    "jdbc_rows": (
        lambda s, d: jdbc_rows(
            ops_view(s, d).withColumn("event_raw", F.repeat("event_raw", 80))
        ),
        f"""with v as ({DUCK_OPS})
        select {_all_columns({"event_raw": "repeat(event_raw, 80)"}, _VIEWED, RELATIONAL_NAMES)} from v""",
    ),
    "write_read_parquet": (
        _round_trip,
        f"""with v as ({DUCK_OPS}) select {_all_columns({}, _VIEWED, {})} from v union all select {_all_columns(
            {"ops": "'HEADER'", "event_name": "'PARQUET_SCHEMA'", "event_raw": "'0.4'"}, {"ops", "event_name", "event_raw"}, {}
        )}""",
    ),
    "stream_ingest": (
        _stream,
        _FILES_SQL,
    ),
    "stream_rejects": (
        lambda s, d: _stream_rejects(s, d).groupBy("reason", "value").agg(F.count("*").alias("n")),
        _STREAM_REJECTS_SQL,
    ),
}
