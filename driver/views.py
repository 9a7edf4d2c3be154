"""The driver's ``events`` table seen as call traces, in Spark SQL and in DuckDB SQL.

``OPS`` is a fact table with the columns the reports read. ``TRACE`` is trace text: one to five
lines per event. Both are plain projections of ``events``, so they grow with it. Each text is
written once; the few spellings that differ between the two engines are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPARK = {
    "S": "string",
    "US": "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))",
    "STAMP": "date_format(cast(ts as timestamp_ntz), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "NTZ": "cast(ts as timestamp_ntz)",
    "LINES": "posexplode(split(body, '\\n')) as (slot, value)",
    "SLOT": "slot",
}
_DUCK = {
    "S": "varchar",
    "US": "epoch_us(ts)",
    "STAMP": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "NTZ": "ts",
    "LINES": "unnest(string_split(body, chr(10))) as value, generate_subscripts(string_split(body, chr(10)), 1) as slot",
    "SLOT": "slot - 1",
}

_OPS = """
select event_id + 1 as line,
       concat('/trace/server_', cast(user_id % 4 as {S}), '/a_rather_long_trace_file_name_', cast(user_id % 4 as {S}), '.trc') as file_name,
       case when user_id % 10 = 0 then '#0' else concat('#', cast(1000 + user_id as {S})) end as cursor_id,
       cast(user_id * 100 + extract(day from ts) as bigint) as span_id,
       case when user_id % 7 = 0 then null else concat('q', cast(user_id % 20 as {S})) end as sql_id,
       case event_type when 'signup' then 'PIC' when 'view' then 'PARSE' when 'click' then 'EXEC'
                       when 'purchase' then 'FETCH' else 'WAIT' end as ops,
       {US} as tim,
       cast(round(value * 100) as bigint) as elapsed_time,
       cast(round(value * 100) as bigint) % 1000 as cpu_time,
       event_id % 7 as ph_reads, event_id % 11 as cr_reads, event_id % 5 as current_reads,
       event_id % 13 as rows_processed,
       case when event_type <> 'error' then '' when event_id % 3 = 0 then 'SQL*Net message from client'
            when event_id % 3 = 1 then 'db file sequential read' else 'SQL*Net message to client' end as event_name,
       concat('select /* q', cast(user_id % 20 as {S}), ' */ col from some_table', chr(10), ' where id = :1') as event_raw,
       concat('c', cast(user_id % 5 as {S})) as client_id,
       {NTZ} as ts
from {EVENTS}
"""

# Trace text of one event; a line feed parts the lines. The event's place in the file is eight
# lines wide, so numbers grow in the order of events and leave gaps, which the operators allow.
_TRACE = """
select file_name, event_id * 8 + {SLOT} + 4 as line, value
from (
  select file_name, event_id, {LINES}
  from (
    select event_id,
      concat('/trace/server_', cast(user_id % 4 as {S}), '.trc') as file_name,
      case
        when event_id % 67 = 3 then concat('*** ', stamp, '+02:00 (PDB(3))')
        when event_id % 71 = 5 then concat('*** CLIENT ID:(c', cast(user_id % 5 as {S}), ') ', stamp, '-01:30')
        when event_id % 73 = 7 then concat('*** ', case event_id % 4 when 0 then 'MODULE NAME' when 1 then 'ACTION NAME' when 2 then 'SERVICE NAME' else 'SESSION ID' end, ':((m', cast(user_id % 3 as {S}), ')) ', stamp)
        when event_id % 79 = 9 then concat('*** CONTAINER ID:(', cast(user_id % 9 as {S}), ') ', stamp, '+00:00')
        when event_id % 83 = 1 then concat('Node name:   host', cast(user_id % 6 as {S}), '.example.com')
        when event_id % 89 = 2 then '====================='
        when event_id % 101 = 4 then concat('no rule knows this line ', cast(event_id as {S}))
        when event_id % 53 = 6 then concat('XCTEND rlbk=', cast(event_id % 2 as {S}), ', rd_only=', cast(event_id % 3 as {S}), case when event_id % 4 = 0 then ',' else concat(', tim=', tim) end)
        when event_id % 51 = 8 then concat('LOBWRITE: type=TEMPORARY LOB,bytes=', cast(event_id % 4096 as {S}), ',c=', cpu, ',e=', ela, ',p=0,cr=0,cu=', case when event_id % 5 = 0 then '' else concat('7,tim=', tim) end)
        when event_id % 59 = 1 then concat('ERROR ', cur, ':err=', cast(event_id % 30000 as {S}), ' tim=', tim)
        when event_id % 61 = 1 then concat('PARSE ERROR ', cur, ':len=18 dep=1 uid=', cast(user_id as {S}), ' oct=3 lid=', cast(user_id + 1 as {S}), ' tim=', tim, ' err=', cast(900 + event_id % 90 as {S}), chr(10), 'select bad syntax ', cast(user_id as {S}))
        when event_type = 'signup' then concat(
          case when event_id % 3 = 0 then concat('=====================', chr(10)) else '' end,
          'PARSING IN CURSOR ', cur, ' len=80 dep=', cast(event_id % 2 as {S}), ' uid=', cast(user_id as {S}), ' oct=3 lid=1 tim=', tim, ' hv=', cast(event_id * 31 as {S}), ' ad=''9d', cast(user_id as {S}), '''',
          case when event_id % 97 = 0 then ' sqlid' else concat(' sqlid=''q', cast(user_id % 20 as {S}), '''') end,
          chr(10), 'select /* q', cast(user_id % 20 as {S}), ' */ col', chr(10), '  from some_table', chr(10), 'END OF STMT')
        when event_type = 'view' and event_id % 3 = 0 then concat('BINDS ', cur, ':', chr(10), ' Bind#0', chr(10), '  value=', cast(user_id as {S}))
        when event_type = 'view' then concat('PARSE ', cur, ':c=', cpu, ',e=', ela, ',p=0,cr=0,cu=0,mis=', cast(event_id % 2 as {S}), ',r=0,dep=0,og=1,plh=', cast(user_id * 7919 as {S}), ',tim=', tim)
        when event_type = 'click' and event_id % 7 = 0 then concat('CLOSE ', cur, ':c=', cpu, ',e=', ela, ',dep=0,type=', cast(event_id % 4 as {S}), ',tim=', tim)
        when event_type = 'click' and event_id % 11 = 0 then concat('EXEC ', cur, ':c=', cpu, ',e=', ela, ',ti')
        when event_type = 'click' then concat('EXEC ', cur, ':c=', cpu, ',e=', ela, ',p=', cast(event_id % 7 as {S}), ',cr=', cast(event_id % 11 as {S}), ',cu=', cast(event_id % 5 as {S}), ',mis=0,r=0,dep=0,og=1,plh=', cast(user_id * 7919 as {S}), ',tim=', tim)
        when event_type = 'purchase' and event_id % 5 = 0 then concat('STAT ', cur, ' id=1 cnt=', cast(event_id % 13 as {S}), ' pid=0 pos=1 obj=', cast(user_id * 3 as {S}), ' op=''TABLE ACCESS FULL''')
        when event_type = 'purchase' then concat('FETCH ', cur, ':c=', cpu, ',e=', ela, ',p=', cast(event_id % 7 as {S}), ',cr=4,cu=0,mis=0,r=', cast(event_id % 13 as {S}), ',dep=0,og=1,plh=', cast(user_id * 7919 as {S}), ',tim=', tim)
        when event_id % 13 = 0 then concat('WAIT ', cur, ': broken')
        when user_id % 11 = 0 then concat('WAIT #0: nam=''SQL*Net message from client'' ela= ', ela, ' driver id=1 #bytes=1 p3=0 obj#=-1 tim=', tim)
        else concat('WAIT ', cur, ': nam=''db file sequential read'' ela= ', ela, ' file#=', cast(user_id as {S}), ' block#=', cast(event_id as {S}), ' blocks=1 obj#=', cast(user_id * 3 as {S}), ' tim=', tim)
      end as body
    from (
      select *, case when user_id % 29 = 0 then '#1' else concat('#', cast(1000 + user_id % 97 as {S})) end as cur,
        cast({US} as {S}) as tim, {STAMP} as stamp,
        cast(cast(round(value * 100) as bigint) as {S}) as ela,
        cast(cast(round(value * 100) as bigint) % 1000 as {S}) as cpu
      from {EVENTS}) e0) e1) e2
"""

DUCK_OPS = _OPS.format(EVENTS="events", **_DUCK)
DUCK_TRACE = _TRACE.format(EVENTS="events", **_DUCK)


def _events(spark: SparkSession, sf_dir: str) -> str:
    return f"parquet.`{sf_dir}/events.parquet`"


def ops_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_OPS.format(EVENTS=_events(spark, sf_dir), **_SPARK))


def trace_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace text of all events.

    Text is many times larger than its events, so these are spread first and the text is made by all
    cores.
    """
    needed = ["event_id", "ts", "user_id", "event_type", "value"]
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(*needed).repartition("event_id")
    return spark.sql(_TRACE.format(EVENTS="{events}", **_SPARK), events=events)
