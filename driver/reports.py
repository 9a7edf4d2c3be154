"""Registered queries over the fact-table view, each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver.views import DUCK_OPS, ops_view
from spanloom.functions.predicates import preds
from spanloom.operators.render import shown_record
from spanloom.plans import histogram as H
from spanloom.plans import reports as R
from spanloom.plans import views as V
from spanloom.plans.histogram_table import add_batch, compact, hours_histogram
from spanloom.sources.stage import stage_path
from spanloom.sources.store import read_clustered, write_clustered

_V = f"with v as ({DUCK_OPS}) "
_ELA = """, ela as (select sql_id, span_id, max(tim) - min(tim) as ela, min(ts) as ts, arg_min(client_id, line) as client_id
  from v where tim is not null and tim <> 0 {idle} group by sql_id, span_id)"""
_CELA = """, cela as (select cursor_id, span_id, max(tim) - min(tim) as ela, min(ts) as ts
  from v where tim is not null group by cursor_id, span_id)"""


def _ela(idle: bool = False) -> str:
    return _ELA.format(idle="and cursor_id <> '#0'" if idle else "")


def _stats(value: str, suffix: str) -> str:
    return (
        f"cast(sum({value}) as bigint) as {'total' if suffix == '_us' else 'sum'}{suffix}, "
        f"cast(median({value}) as double) as median{suffix}, "
        f"percentile_disc(0.99) within group (order by {value}) as p99{suffix}, "
        f"max({value}) as max{suffix}"
    )


def _summary_sql(where: str, limit: int | None, idle: bool = False) -> str:
    return f"""{_V}{_ela(idle)},
    s as (select sql_id, count(*) as executions, {_stats('ela', '_us')} from ela {where} group by sql_id),
    t as (select sql_id, arg_min(event_raw, (file_name, line)) as sql_text from v where ops = 'PIC' group by sql_id),
    r as (select row_number() over (order by executions asc, sql_id desc nulls last) as rownum, * from s)
    select rownum, coalesce(r.sql_id, 'NULL') as sql_id,
      coalesce(regexp_replace(substring(sql_text, 0, 30), '[\\r\\n]', '', 'g'), 'NULL') as sql_text,
      executions, total_us, median_us, p99_us, max_us
    from r left join t on r.sql_id = t.sql_id order by rownum desc {limit and f'limit {limit}' or ''}"""


def _outliers_sql(where: str, having: str, statistic: str, limit: int) -> str:
    return f"""{_V},
    g as (select cursor_id, span_id, cast(sum({statistic}) as bigint) as total, min(line) as first_line,
      arg_min(file_name, line) as f, arg_min(ts, line) as ts from v {where} group by cursor_id, span_id
      having sum({statistic}) {having}),
    r as (select row_number() over (order by total asc, cursor_id desc, span_id desc) as rownum, * from g)
    select rownum, cursor_id as cursor, total as {statistic}, ts,
      case when length(f) > 30 then '<...>' || right(f, 36) else f end as file_name, f as file_path, first_line
    from r order by rownum desc limit {limit}"""


def _waits_sql(extra: str, limit: int, idle: bool = False) -> str:
    return f"""{_V}{_ela(idle)},
    w as (select case when event_name like 'SQL*Net message%' and cursor_id = '#0' then event_name || '/idle' else event_name end as wait,
      elapsed_time from v where ops = 'WAIT' {extra}),
    g as (select wait, count(*) as count, cast(sum(elapsed_time) as bigint) as sum_us, median(elapsed_time) as median_us,
      percentile_disc(0.99) within group (order by elapsed_time) as p99_us, max(elapsed_time) as max_us from w group by wait)
    select row_number() over (order by count asc, wait desc) as rownum, * from g order by rownum desc limit {limit}"""


_METRICS_SQL = f"""{_V}, m as (select span_id, {', '.join(f'cast(sum({m}) as bigint) as {m}' for m in V.METRICS)}
  from v where sql_id = 'q3' group by span_id) """ + " union all ".join(
    f"select '{shown}' as statistic, cast(sum({m}) as bigint) as sum, median({m}) as median, "
    f"percentile_disc(0.99) within group (order by {m}) as p99, max({m}) as max from m"
    for m, shown in R._METRIC_NAMES.items()
)

_OP_STATS = ", ".join(
    f"cast(sum({c}) as bigint) as sum_{s}, median({c}) as median_{s}, "
    f"percentile_disc(0.99) within group (order by {c}) as p99_{s}, max({c}) as max_{s}"
    for c, s in (("cpu_time", "cpu"), ("elapsed_time", "elapsed"))
)

# Bucket bounds by the length of the binary form; levels of the percentile ladder in closed form.
_HIST = """, h as (select name, (x >> s) << s as value_low, ((x >> s) << s) + (1::bigint << s) - 1 as value_high, count(*) as count
  from (select name, x, greatest(0, length(bin(x)) - 5) as s from src) group by all)"""
_DIST = """, c as (select name, value_low, value_high, count, sum(count) over (partition by name order by value_low) as upto, sum(count) over (partition by name) as total from h),
  lad as (select 100.0::double - 100.0::double / (2::double ** (i // 5)) + (i % 5) * 10.0::double / (2::double ** (i // 5)) as level from range(0, 230) t(i)),
  b as (select *, 100.0::double * upto / total as share, case when upto = count then -1.0::double else 100.0::double * (upto - count) / total end as before from c),
  m as (select b.*, level, row_number() over (partition by name, value_low order by level) as k from b join lad on level > before and level <= share)"""
_HIST_SPANS = f"""{_V}{_ela()}, src as (select sql_id as name, ela as x from ela where sql_id in ('q1', 'q2', 'q3')){_HIST}"""
_HIST_WAIT = f"""{_V}, src as (select event_name as name, elapsed_time as x from v
  where ops = 'WAIT' and event_name = 'db file sequential read'){_HIST}"""
_DIST_COLS = """select name, value_high as value, level / 100.0::double as percentile, cast(upto as bigint) as total_count,
  1.0::double / (1.0::double - level / 100.0::double) as inverse from m where upto < total or k = 1
  union all select name, value_high, 1.0::double, cast(upto as bigint), null from b where upto = total"""

_FILTERED_SQL = _summary_sql(
    "where ts >= timestamp '2024-01-03 00:00:00' and ts < timestamp '2024-01-25 12:00:00' "
    "and client_id = 'c3' and sql_id in ('q3', 'q8', 'q13')",
    2,
    True,
)
_FILTERED = ("2024-01-03 00:00:00", "2024-01-25 12:00:00", "c3", "q3,q8,q13")


def _summary_clustered(spark, sf_dir: str):
    """``summary_filtered`` over a stored table that is laid out for it."""
    path = stage_path(spark, "clustered_ops")
    write_clustered(ops_view(spark, sf_dir), path, row_group_bytes=1 << 20)
    start, end, _, ids = _FILTERED
    part = read_clustered(spark, path, start, end, ids)
    return R.summary(read_clustered(spark, path), preds(*_FILTERED), limit=2, remove_idle=True, executions=part)


_HOURS = ("2024-01-05 03:00:00", "2024-01-19 17:00:00")


def _histogram_hours(spark, sf_dir: str):
    """Histograms of a range of hours from a stored table that took the spans in three batches."""
    path = stage_path(spark, "hours")
    ops = ops_view(spark, sf_dir)
    for batch in range(3):
        add_batch(ops.where(F.col("span_id") % 3 == batch), path, f"b{batch}")
        if batch == 1:
            compact(spark, path)
    sql = hours_histogram(spark, path, "sql", *_HOURS, names="q1,q2,q3")
    return sql.unionByName(hours_histogram(spark, path, "wait", *_HOURS))


_HOURS_SQL = f"""{_V}{_ela()}, src as (select sql_id as name, ela as x from ela where sql_id in ('q1', 'q2', 'q3') and ts >= timestamp '{_HOURS[0]}' and ts < timestamp '{_HOURS[1]}'
  union all select event_name, elapsed_time from v where ops = 'WAIT' and ts >= timestamp '{_HOURS[0]}' and ts < timestamp '{_HOURS[1]}'){_HIST} select * from h"""


REPORT_QUERIES = {
    "read_ops_project": (
        lambda s, d: shown_record(ops_view(s, d)).select(
            "span_id", "sql_id", "cursor_id", "operation", "cpu_time", "elapsed_time", "tim", "file_name", "line"
        ),
        f"""{_V} select span_id, sql_id, cursor_id, case when ops = 'PIC' then 'PARSING IN CURSOR' else ops end as operation,
        cpu_time, elapsed_time, tim, file_name, line from v""",
    ),
    "span_elapsed": (
        lambda s, d: V.span_elapsed(ops_view(s, d)),
        f"{_V}{_ela()} select * from ela",
    ),
    "span_elapsed_no_idle": (
        lambda s, d: V.span_elapsed(ops_view(s, d), remove_idle=True),
        f"{_V}{_ela(True)} select * from ela",
    ),
    "cursor_elapsed": (
        lambda s, d: V.cursor_elapsed(ops_view(s, d)),
        f"{_V}{_CELA} select * from cela",
    ),
    "span_wall_elapsed": (
        lambda s, d: V.span_wall_elapsed(ops_view(s, d)),
        f"{_V} select sql_id, span_id, epoch_us(max(ts)) - epoch_us(min(ts)) as duration_us from v where ts is not null group by all",
    ),
    "span_metrics": (
        lambda s, d: V.span_metrics(ops_view(s, d)),
        f"{_V} select span_id, {', '.join(f'cast(sum({m}) as bigint) as {m}' for m in V.METRICS)} from v group by span_id",
    ),
    "sql_texts": (
        lambda s, d: V.sql_texts(ops_view(s, d), "sql_id"),
        f"{_V} select sql_id, arg_min(event_raw, (file_name, line)) as sql_text from v where ops = 'PIC' group by sql_id",
    ),
    "summary": (lambda s, d: R.summary(ops_view(s, d)), _summary_sql("", 30)),
    "summary_all": (lambda s, d: R.summary(ops_view(s, d), limit=None), _summary_sql("", None)),
    "summary_filtered": (
        lambda s, d: R.summary(
            ops_view(s, d),
            preds(*_FILTERED),
            limit=2,
            remove_idle=True,
        ),
        _FILTERED_SQL,
    ),
    "summary_clustered": (_summary_clustered, _FILTERED_SQL),
    "cursor_summary": (
        lambda s, d: R.cursor_summary(ops_view(s, d)),
        f"""{_V}{_CELA}, s as (select cursor_id, count(*) as execs, median(ela) as median,
          percentile_disc(0.99) within group (order by ela) as p99 from cela group by cursor_id),
        t as (select cursor_id, arg_min(event_raw, (file_name, line)) as sql_text from v where ops = 'PIC' group by cursor_id)
        select s.cursor_id, sql_text, execs, median, p99 from s left join t on s.cursor_id = t.cursor_id""",
    ),
    "outliers": (
        lambda s, d: R.outliers(ops_view(s, d), 20000),
        _outliers_sql("", "> 20000", "elapsed_time", 30),
    ),
    "outliers_band": (
        lambda s, d: R.outliers(
            ops_view(s, d), "500,1500", preds(sql_ids=["q3", "q4"]), "cpu_time", limit=10
        ),
        _outliers_sql("where sql_id in ('q3', 'q4')", "between 500 and 1500", "cpu_time", 10),
    ),
    "outliers_no_threshold": (
        lambda s, d: R.outliers(ops_view(s, d), statistic="ph_reads"),
        _outliers_sql("", "<> 0", "ph_reads", 30),
    ),
    "waits": (lambda s, d: R.waits(ops_view(s, d)), _waits_sql("", 30)),
    "waits_filtered": (
        lambda s, d: R.waits(ops_view(s, d), preds(start="2024-01-10", sql_ids="q1,q2,q10"), limit=3),
        _waits_sql("and ts >= timestamp '2024-01-10' and sql_id in ('q1', 'q2', 'q10')", 3),
    ),
    "waits_slow_spans": (
        lambda s, d: R.waits(ops_view(s, d), slower_than=3_600_000_000),
        _waits_sql(
            "and span_id in (select span_id from ela where ela > 3600000000) and cursor_id <> '#0'", 30
        ),
    ),
    "db_totals": (
        lambda s, d: R.db_totals(ops_view(s, d)),
        f"""{_V} select count(*) as rows, count(distinct file_name) as files, count(distinct sql_id) as sql_ids,
        count(distinct cursor_id) as cursors, min(ts) as first_timestamp, max(ts) as last_timestamp from v""",
    ),
    "db_files": (
        lambda s, d: R.db_files(ops_view(s, d)),
        f"""{_V}, g as (select file_name as f, count(*) as rows, min(ts) as a, max(ts) as z, max(tim) - min(tim) as u from v group by file_name)
        select row_number() over (order by rows asc, f desc) as rownum,
          case when length(f) > 30 then '<...>' || right(f, 21) else f end as file_name, f as file_path, rows,
          date_trunc('second', a) as first_timestamp, date_trunc('second', z) as last_timestamp,
          cast(epoch(date_trunc('second', z) - date_trunc('second', a)) as bigint) as wallclock_s,
          cast(round(u / 1000000) as integer) as elapsed_s from g order by rownum desc limit 30""",
    ),
    "sql_metrics": (lambda s, d: R.sql_metrics(ops_view(s, d), "q3"), _METRICS_SQL),
    "sql_ops": (
        lambda s, d: R.sql_ops(ops_view(s, d), "q3"),
        f"""{_V} select case when ops = 'PIC' then 'PARSING IN CURSOR' else ops end as operation, count(*) as count, {_OP_STATS}
        from v where sql_id = 'q3' and ops in ('PIC', 'PARSE', 'EXEC', 'CLOSE', 'WAIT', 'FETCH', 'ERROR') group by ops""",
    ),
    "hdr_histogram": (
        lambda s, d: H.hdr_histogram(ops_view(s, d), ["ops"], "elapsed_time"),
        f"{_V}, src as (select ops as name, elapsed_time as x from v){_HIST} select name as ops, value_low, value_high, count from h",
    ),
    "histogram_sql_id": (
        lambda s, d: H.histogram(ops_view(s, d), sql_ids="q1,q2,q3"),
        f"{_HIST_SPANS} select * from h",
    ),
    "histogram_hours": (_histogram_hours, _HOURS_SQL),
    "histogram_wait": (
        lambda s, d: H.histogram(ops_view(s, d), wait_name="db file sequential read"),
        f"{_HIST_WAIT} select * from h",
    ),
    "percentile_distribution": (
        lambda s, d: H.percentile_distribution(
            H.histogram(ops_view(s, d), wait_name="db file sequential read"), ["name"]
        ),
        f"{_HIST_WAIT}{_DIST} {_DIST_COLS}",
    ),
    "percentile_distribution_by_op": (
        lambda s, d: H.percentile_distribution(
            H.hdr_histogram(
                ops_view(s, d).withColumnRenamed("ops", "name"), ["name"], "elapsed_time"
            ),
            ["name"],
        ),
        f"{_V}, src as (select ops as name, elapsed_time as x from v){_HIST}{_DIST} {_DIST_COLS}",
    ),
    "percentile_lines": (
        lambda s, d: H.percentile_lines(
            H.histogram(ops_view(s, d), wait_name="db file sequential read"), "name"
        ).select("name", F.round("position", 9).alias("position"), "value"),
        f"""{_HIST_WAIT}{_DIST}, d as ({_DIST_COLS}),
        z as (select name, sum((value_low + (value_high - value_low + 1) // 2) * count) / sum(count)::double as mean,
          sum((value_low + (value_high - value_low + 1) // 2) ** 2 * count) / sum(count)::double as sq, max(value_high) as top, sum(count) as n from h group by name)
        select name, round(1 + percentile, 9) as position, case when inverse is null then format('{{:12.1f}} {{:2.12f}} {{:10d}}', value::double, percentile, total_count)
          else format('{{:12.1f}} {{:2.12f}} {{:10d}} {{:14.2f}}', value::double, percentile, total_count, inverse) end as value from d
        union all select name, 0, '       Value     Percentile TotalCount 1/(1-Percentile)' from z
        union all select name, 0.1, '' from z
        union all select name, 3, format('#[Mean    = {{:12.1f}}, StdDeviation   = {{:12.1f}}]', mean, sqrt(sq - mean * mean)) from z
        union all select name, 4, format('#[Max     = {{:12.1f}}, Total count    = {{:12d}}]', top::double, n::bigint) from z
        union all select name, 5, format('#[Buckets = {{:12d}}, SubBuckets     =           32]', greatest(26, length(bin(top::bigint)) - 4)) from z""",
    ),
    "histogram_summary": (
        lambda s, d: H.histogram_summary(
            H.histogram(ops_view(s, d), wait_name="db file sequential read"), ["name"]
        ).select("name", F.round("mean", 3).alias("mean"), F.round("std_deviation", 3).alias("std_deviation"), "max", "total_count"),
        f"""{_HIST_WAIT}, m as (select *, value_low + (value_high - value_low + 1) // 2 as mid from h)
        select name, round(sum(mid * count) / sum(count)::double, 3) as mean,
        round(sqrt(sum(mid ** 2 * count) / sum(count)::double - (sum(mid * count) / sum(count)::double) ** 2), 3) as std_deviation,
        max(value_high) as max, cast(sum(count) as bigint) as total_count from m group by name""",
    ),
}
