"""Files of one process, numbers of files, spans of equal ids, filters of keys, and the clustered table."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spanloom.functions.filters import bloom_filter, may_hold, semi_join, slices_for
from spanloom.functions.predicates import preds
from spanloom.operators.sequence import in_sequence, out_of_sequence, place_files
from spanloom.operators.spans import number_spans
from spanloom.plans import reports as R
from spanloom.plans import views as V
from spanloom.plans.export import export_spans
from spanloom.plans.ingest import ingest
from spanloom.sources.files import file_dictionary, number_files
from spanloom.sources.store import read_clustered, read_ops, write_clustered, write_ops
from tests.test_reports import ops_frame, ops_row

HEAD = "one\ntwo\nthree\n"
FIRST = HEAD + """*** 2024-03-01T10:00:00.000000+00:00
*** CLIENT ID:(web) 2024-03-01T10:00:00.000000+00:00
PARSING IN CURSOR #4711 len=20 dep=0 uid=9 oct=3 lid=9 tim=1000 hv=77 ad='ab12' sqlid='stmt1'
select 1
END OF STMT
PARSE #4711:c=5,e=6,tim=1000
EXEC #4711:c=5,e=6,tim=2000
"""
# Goes on with the open cursor; its own wall clock comes late. By name it is before the first file.
SECOND = HEAD + """FETCH #4711:c=1,e=2,r=1,tim=3000
CLOSE #4711:c=1,e=2,tim=4000
*** 2024-03-01T10:00:09.000000+00:00
EXEC #4711:c=5,e=6,tim=9000
"""
OTHER = HEAD + "FETCH #4711:c=1,e=2,r=1,tim=3000\n"


@pytest.fixture(scope="module")
def rotated(tmp_path_factory):
    folder = tmp_path_factory.mktemp("rotated")
    for name, text in (("b_77.1.trc", FIRST), ("a_77.2.trc", SECOND), ("c_78.1.trc", OTHER)):
        (folder / name).write_text(text)
    return str(folder)


def _calls(ops):
    rows = ops.where("cursor_id is not null").orderBy("file_name", "line").collect()
    return [(r["file_name"].rsplit("/", 1)[1][0], r["ops"], r["sql_id"], r["ts"] and r["ts"].microsecond, r["span_id"], r["client_id"]) for r in rows]


@pytest.mark.parametrize("ids", ["hash", "unique", "dense"])
def test_spans_statements_and_clock_pass_file_borders(spark, rotated, ids):
    alone = _calls(ingest(spark, [rotated], ids=ids).ops)
    assert [c[:4] for c in alone if c[0] == "a"] == [("a", "FETCH", None, None), ("a", "CLOSE", None, None), ("a", "EXEC", None, 0)]
    found = _calls(ingest(spark, [rotated], ids=ids, stream_key=r"regexp_extract(file_name, '_(\\d+)[.]', 1)").ops)
    assert [c[:4] for c in found] == [
        ("a", "FETCH", "stmt1", 2000), ("a", "CLOSE", "stmt1", 3000), ("a", "EXEC", "stmt1", 0),
        ("b", "PIC", "stmt1", 0), ("b", "PARSE", "stmt1", 0), ("b", "EXEC", "stmt1", 1000),
        ("c", "FETCH", None, None),
    ]
    spans = [c[4] for c in found]
    assert len({*spans[:2], *spans[3:6]}) == 1 and spans[2] != spans[0] and spans[6] not in spans[:6]
    assert [c[5] for c in found] == [None] * 3 + ["web"] * 3 + [None]  # session attributes end with their file


def test_files_follow_by_first_clock_then_name(spark):
    rows = [("z", 1, "STAR", "10:00"), ("z", 9, "EXEC", None), ("y", 2, "EXEC", None), ("x", 5, "STAR", "09:00"), ("x", 20, "STAR", "08:00"), ("w", 3, "EXEC", None)]
    df = spark.createDataFrame(rows, "file_name string, line bigint, ops string, at string").withColumn(
        "ts", F.expr("cast(concat('2024-01-01 ', at) as timestamp_ntz)")
    )
    places = place_files(df, "'p'", size=8)
    assert [r[0] for r in places.orderBy("_shift").collect()] == ["x", "z", "w", "y"]
    moved = in_sequence(df, places)
    lines = [r["line"] for r in moved.collect()]
    assert len(set(lines)) == len(lines) == 6 and {r["file_name"] for r in moved.collect()} == {"p"}
    back = out_of_sequence(moved).select(df.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    alone = place_files(df, "nullif(file_name, 'z')", size=8).collect()
    assert {r["file_name"]: (r["_stream"], r["_shift"]) for r in alone} == {f: (f, 0) for f in "wxyz"}


def test_dictionary_only_grows(spark, tmp_path):
    path = str(tmp_path / "files")
    names = [f"f{i:04d}" for i in range(500)]
    random.Random(1).shuffle(names)

    def numbers(some):
        df = spark.createDataFrame([(n,) for n in [*some, *some[:9]]], "file_name string")
        return {r[0]: r[1] for r in file_dictionary(df, path).collect()}

    one = numbers(names[:200])
    two = numbers(names[100:])
    assert {n: one[n] for n in names[100:200]} == {n: two[n] for n in names[100:200]}
    assert sorted({**one, **two}.values()) == list(range(500))
    assert numbers(names) == {**one, **two}
    assert number_files(spark.createDataFrame([], "file_name string")).collect() == []


def test_unique_ids_refuse_what_does_not_fit(spark):
    cut = spark.sql("select 'f' as file_name, '#10' as _cursor, 5L as _mark, 'EXEC' as ops")
    segmented = spark.sql("select 'f' as file_name, '#10' as cursor_id, 'EXEC' as ops, 5L as line, 5L as _pic, 0L as _reset")
    few, many = (spark.sql(f"select 'f' as file_name, {n}L as file_number") for n in ((1 << 27) - 1, 1 << 27))
    assert number_spans(cut, "unique", segmented=segmented, numbers=few).first()["span_id"] == ((1 << 27) - 1 << 36) + 5
    with pytest.raises(Exception, match="too many files or lines"):
        number_spans(cut, "unique", segmented=segmented, numbers=many).collect()
    with pytest.raises(ValueError):
        number_spans(cut, "unique")


def test_spans_of_two_files_with_one_id_stay_apart(spark):
    rows = []
    for file, cursor in (("f", "#100"), ("g", "#100")):
        rows += [ops_row(span_id=1, sql_id="q", cursor_id=cursor, file_name=file, tim=10, line=1, elapsed_time=5)]
        rows += [ops_row(span_id=1, sql_id="q", cursor_id=cursor, file_name=file, tim=10 + len(file + cursor) + 100 * (file == "g"), line=2, elapsed_time=7)]
        rows += [ops_row(span_id=1, cursor_id=cursor, file_name=file, ops="WAIT", event_name=f"wait {file}", line=3)]
    df = ops_frame(spark, rows)
    assert sorted((r["file_name"], r["n_events"]) for r in export_spans(df).collect()) == [("f", 3), ("g", 3)]
    assert [(r["span_id"], r["n_events"]) for r in export_spans(df, across_files=True).collect()] == [(1, 6)]
    assert V.span_elapsed(df).count() == 2 and V.span_elapsed(df, across_files=True).count() == 1
    assert sorted((r["file_path"], r["elapsed_time"]) for r in R.outliers(df).collect()) == [("f", 12), ("g", 12)]
    assert [r["elapsed_time"] for r in R.outliers(df, across_files=True).collect()] == [24]
    assert [r["wait"] for r in R.waits(df, slower_than=50).collect()] == ["wait g"]
    assert {r["wait"] for r in R.waits(df, slower_than=50, across_files=True).collect()} == {"wait f", "wait g"}
    assert V.span_metrics(df).count() == 2 and V.cursor_elapsed(df).count() == 2


@pytest.mark.parametrize("count", [0, 1, 20_000])
def test_filters_lose_nothing_and_let_little_pass(spark, count):
    keys = spark.range(count).selectExpr("id * 7 as a", "cast(id as string) as b")
    slices = slices_for(count)
    rows = spark.range(60_000).selectExpr("id * 7 as a", "cast(id as string) as b", "id as _slice", "'x' as _hash")
    passed = may_hold(rows, ["a", "b"], bloom_filter(keys, ["a", "b"], slices), slices)
    assert passed.columns == rows.columns
    assert passed.where(f"a < {7 * count}").count() == count
    assert passed.count() - count < 0.02 * 60_000
    assert semi_join(rows, keys, ["a", "b"]).count() == count
    assert slices_for(1 << 30) == 0  # too many keys: the join alone


def test_slow_spans_prune_the_waits_that_move(spark):
    rows = spark.range(40_000).selectExpr(
        "id div 4 as span_id", "'f' as file_name", "'q' as sql_id", "concat('#', 100 + id % 9) as cursor_id", "'w' as event_name",
        "if(id % 4 = 0, 'WAIT', 'EXEC') as ops", "if(id % 4 = 3 and id < 400, 1000000L, 1L) + id % 4 as tim", "id as line", "1L as elapsed_time",
        "cast(null as timestamp_ntz) as ts", "'c' as client_id",
    )
    slow = V.slow_spans(rows, 1000)
    waits = rows.where("ops = 'WAIT'").select("elapsed_time", *V.span_key(rows))
    slices = slices_for(slow.count())
    moved = may_hold(waits, slow.columns, bloom_filter(slow, slow.columns, slices), slices)
    assert waits.count() == 10_000 and moved.count() < 120
    assert R.waits(rows, slower_than=1000).first()["count"] == 100


def _stored(spark):
    pick = random.Random(8)
    rows = []
    for span in range(1500):
        day, hour, statement = pick.randrange(1, 29), pick.randrange(24), f"q{0 if pick.random() < 0.4 else pick.randrange(1, 40)}"
        steps = [0, 1, 30 * 3600 if pick.random() < 0.05 else 2]
        for i, seconds in enumerate(steps):
            rows.append((span, statement, day, hour, seconds, 3 * span + i, ["PIC", "EXEC", "WAIT"][i]))
    rows.append((1700, "q1", 0, 0, 0, 5000, "EXEC"))  # no wall clock
    df = spark.createDataFrame(rows, "span_id long, sql_id string, day int, hour int, s int, line long, ops string")
    return ops_frame(spark, [ops_row()]).limit(0).unionByName(
        df.selectExpr(
            "span_id", "sql_id", "ops", "line", "concat('f', span_id % 3) as file_name", "'#100' as cursor_id", "line * 10 + s + 1 as tim", "'c' as client_id",
            "if(day = 0, null, make_timestamp_ntz(2024, 1, day, hour, 0, 0) + make_dt_interval(0, 0, 0, s)) as ts", "repeat(sql_id, 40) as event_raw",
        ),
        allowMissingColumns=True,
    )


def test_clustered_table_holds_the_same_rows_and_reads_few(spark, tmp_path):
    plain, path = str(tmp_path / "plain"), str(tmp_path / "clustered")
    ops = _stored(spark)
    write_ops(ops, plain)
    write_clustered(ops, path, files=6, row_group_bytes=1 << 12)
    assert sorted(map(repr, read_clustered(spark, path).collect())) == sorted(map(repr, read_ops(spark, plain).collect()))

    wanted = preds("2024-01-10 06:00:00", "2024-01-12 18:00:00", sql_ids="q3,q0,q9")
    part = read_clustered(spark, path, "2024-01-10 06:00:00", "2024-01-12 18:00:00", "q3,q0,q9")
    full, pruned = (sorted(map(tuple, R.summary(read_ops(spark, plain), wanted, executions=p).collect())) for p in (None, part))
    assert full == pruned and len(full) >= 2
    everything, narrow = (_scanned(df) for df in (read_clustered(spark, path), part))
    assert everything == 4502 and narrow < 0.25 * everything
    files = [pq.ParquetFile(f) for f in part.inputFiles()]
    groups = sum(f.metadata.num_row_groups for f in files)
    assert groups > 0 and spark.read.parquet(path).where("span_day = date'0001-01-01'").count() > 0
    assert read_clustered(spark, path, sql_ids="none").count() == 0


def _scanned(df):
    """Rows that the scan of a plain read hands on."""
    df = df.select("span_id", "sql_id", "ts")
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
