"""Statistics, filters, histograms and sinks."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spanloom.functions.predicates import preds, threshold
from spanloom.functions.quantiles import grouped_stats
from spanloom.functions.trace_text import utc_time
from spanloom.operators.render import render_line
from spanloom.plans import histogram as H
from spanloom.plans import reports as R
from spanloom.plans.export import export_events, export_spans, write_spans
from spanloom.schema import OPS_COLUMNS, OPS_SCHEMA
from spanloom.sources.store import jdbc_rows, read_ops, write_ops
from spanloom.streaming.ingest import stream_ingest
from tests import traces


def ops_row(**given):
    blank = {f.name: 0 if f.dataType.typeName() in ("long", "integer") else None for f in OPS_SCHEMA}
    return {**blank, "tim": None, "ops": "EXEC", "cursor_id": "#100", "file_name": "f", **given}


def ops_frame(spark, rows):
    return spark.createDataFrame([[r[c] for c in OPS_COLUMNS] for r in rows], OPS_SCHEMA)


def test_grouped_stats_equal_sorting(spark):
    rng = random.Random(5)
    data = {
        "hot": [int(rng.lognormvariate(9, 4)) for _ in range(3000)],
        "one": [7],
        "pair": [1, 4],
        "same": [10**12] * 50,
        "big": [10**12 + rng.randrange(10**6) for _ in range(300)],
        "neg": [rng.randrange(-5000, 5000) for _ in range(101)],
        None: [3, 1, 2],
    }
    rows = [(k, v) for k, values in data.items() for v in values] + [("hot", None), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v bigint")
    found = {r["k"]: r for r in grouped_stats(df, ["k"], "v").collect()}
    assert set(found) == {*data, "none"}
    for k, values in data.items():
        s, n = sorted(values), len(values)
        r = found[k]
        assert r["median"] == (s[(n - 1) // 2] + s[n // 2]) / 2
        assert r["p99"] == s[n - n // 100 - 1]
        assert (r["total"], r["max"]) == (sum(s), s[-1])
        assert r["n"] == n + (k == "hot")
    assert (found["none"]["n"], found["none"]["median"]) == (1, None)


def test_preds_and_threshold(spark):
    assert preds() is None
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h) as ts, 'c' as client_id, "
        "concat('q', h) as sql_id, h from range(5) t(h)"
    )

    def kept(condition):
        return [r["h"] for r in df.where(condition).orderBy("h").collect()]

    assert kept(preds(start="2024-01-01 01:00:00")) == [1, 2, 3, 4]
    assert kept(preds(end="2024-01-01 01:00:00")) == [0]
    assert kept(preds(client_id="c", sql_ids="q1,q3")) == [1, 3]
    assert kept(threshold("2", F.col("h"))) == [3, 4]
    assert kept(threshold("1,3", F.col("h"))) == [1, 2, 3]
    assert kept(threshold([2, 2], F.col("h"))) == [2]
    assert threshold("", F.col("h")) is None and threshold(None, F.col("h")) is None
    with pytest.raises(ValueError):
        threshold("1,2,3", F.col("h"))


def test_summary_ranks_all_groups_but_shows_the_top(spark):
    rows = []
    for q, spans in (("a", 3), ("b", 5), ("c", 1), (None, 5)):
        for s in range(spans):
            for t in (100, 150 + s):
                rows.append(ops_row(sql_id=q, span_id=hash((q, s)) % 10**6, tim=t, line=len(rows)))
    rows.append(ops_row(sql_id="a", ops="PIC", event_raw="select\r\n " + "x" * 50, line=len(rows)))
    found = R.summary(ops_frame(spark, rows), limit=3).collect()
    assert [(r["rownum"], r["sql_id"], r["executions"]) for r in found] == [
        (4, "NULL", 5), (3, "b", 5), (2, "a", 3),
    ]
    assert found[2]["sql_text"] == "select " + "x" * 20
    assert found[0]["sql_text"] == "NULL"


def test_outliers_count_first_line_and_cut_names(spark):
    rows = [
        ops_row(span_id=1, elapsed_time=5, line=9, file_name="/long/" + "p" * 40),
        ops_row(span_id=1, elapsed_time=6, line=3, file_name="/long/" + "p" * 40),
        ops_row(span_id=2, elapsed_time=50, line=4),
        ops_row(span_id=3, elapsed_time=0, line=5),
    ]
    df = ops_frame(spark, rows)
    found = R.outliers(df).collect()
    assert [(r["elapsed_time"], r["first_line"], r["rownum"]) for r in found] == [(50, 4, 2), (11, 3, 1)]
    assert found[1]["file_name"] == "<...>" + "p" * 36
    assert [r["elapsed_time"] for r in R.outliers(df, "10,11").collect()] == [11]


def test_percentile_ladder(spark):
    rng = random.Random(3)
    values = [rng.randrange(1, 100000) for _ in range(499)] + [1 << 40]
    df = spark.createDataFrame([("x", v) for v in values], "name string, v bigint")
    buckets = H.hdr_histogram(df, ["name"], "v").orderBy("value_low").collect()
    assert sum(b["count"] for b in buckets) == 500
    for b in buckets:
        assert b["count"] == sum(b["value_low"] <= v <= b["value_high"] for v in values)
    want, level, cum, i = [], 0.0, buckets[0]["count"], 0
    while True:  # step through levels and buckets together
        while 100.0 * cum / 500 < level:
            i += 1
            cum += buckets[i]["count"]
        want.append((buckets[i]["value_high"], level / 100.0, cum))
        if cum == 500:
            break
        half = 2
        while 100.0 / half > 100.0 - level - 1e-12:
            half *= 2
        level += 100.0 / (5 * half)
    want.append((buckets[-1]["value_high"], 1.0, 500))
    found = H.percentile_distribution(H.hdr_histogram(df, ["name"], "v"), ["name"])
    got = [
        (r["value"], r["percentile"], r["total_count"])
        for r in found.orderBy("percentile").collect()
    ]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[2] == w[2] and abs(g[1] - w[1]) < 1e-12


def test_write_percentiles(spark, tmp_path):
    df = spark.createDataFrame([("q1", 5), ("q1", 9), ("q2", 7)], "name string, v bigint")
    H.write_percentiles(H.hdr_histogram(df, ["name"], "v"), "name", str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out" / "name=q1").glob("part-*"))
    lines = text.splitlines()
    assert lines[0].split() == ["Value", "Percentile", "TotalCount", "1/(1-Percentile)"]
    assert lines[1] == ""
    assert lines[2].split() == ["5.0", "0.000000000000", "1", "1.00"]
    assert lines[-4].split() == ["9.0", "1.000000000000", "2"]
    assert lines[-3].startswith("#[Mean    =") and lines[-1].startswith("#[Buckets =")


def test_store_round_trip(spark, tmp_path):
    df = ops_frame(spark, [ops_row(span_id=1, line=1, tim=5), ops_row(span_id=2, line=2)])
    write_ops(df, str(tmp_path / "ops"), rows_per_file=1)
    back = read_ops(spark, str(tmp_path / "ops"))
    assert back.schema.fieldNames() == OPS_COLUMNS
    assert back.count() == 3
    version = back.where("event_name = 'PARQUET_SCHEMA'").first()
    assert (version["ops"], version["event_raw"]) == ("HEADER", "0.4")


def test_reads_unsigned_files(spark, tmp_path):
    table = pa.table(
        {
            "span_id": pa.array([1, 2], pa.uint64()),
            "tim": pa.array([0, 9], pa.uint64()),
            "cursor_missed": pa.array([1, 0], pa.uint8()),
            "ops": pa.array(["STAT", "EXEC"]),
            "ts": pa.array([0, 1], pa.timestamp("us")),
        }
    )
    pq.write_table(table, tmp_path / "x.parquet")
    df = read_ops(spark, str(tmp_path))
    assert [f.dataType for f in df.schema] == [f.dataType for f in OPS_SCHEMA]
    assert [r["tim"] for r in df.orderBy("span_id").collect()] == [None, 9]


def test_relational_rows(spark):
    df = ops_frame(spark, [ops_row(event_raw="y" * 5000, event_name="n")])
    assert jdbc_rows(df).first()["wait_raw"] == "y" * 5000
    rows = jdbc_rows(df, 4000)
    assert "wait_raw" in rows.columns and "event_raw" not in rows.columns
    assert (len(rows.first()["wait_raw"]), rows.first()["wait_name"]) == (4000, "n")


def test_export(spark, tmp_path):
    df = spark.sql(
        "select span_id, sql_id, ops, line, timestamp_ntz'1970-01-01 00:00:01' + make_dt_interval(0,0,0,line) as ts, "
        "client_id, 'm' as module from values (1L,'q','EXEC',2L,'c'), (1L,'q','PIC',1L,'c'), (2L,null,'STAR',3L,'c') "
        "t(span_id, sql_id, ops, line, client_id)"
    )
    docs = export_spans(df).collect()
    assert len(docs) == 1
    doc = docs[0]
    assert (doc["trace_id"], doc["name"], doc["start_ns"], doc["end_ns"]) == (
        "c", "q", 2_000_000_000, 3_000_000_000,
    )
    assert (doc["first_line"], doc["n_events"]) == (1, 2)
    assert [e["name"] for e in export_events(df).orderBy("line").collect()] == ["PARSING IN CURSOR", "EXEC"]
    assert export_spans(df, "MODULE").first()["trace_id"] == "m"
    with pytest.raises(ValueError):
        export_spans(df, "ECID")
    write_spans(df, str(tmp_path / "docs"))
    assert [spark.read.json(str(tmp_path / "docs" / part)).count() for part in ("spans", "events")] == [1, 2]


def test_render(spark):
    df = ops_frame(
        spark,
        [
            ops_row(ops="WAIT", event_raw=" nam='x' ela= 1 a tim=2", line=1),
            ops_row(ops="EXEC", cpu_time=3, tim=9, line=2),
            ops_row(ops="XCTEND", rd_only=1, line=3),
            ops_row(ops="STAR", event_name="CLIENT ID", event_raw="c", line=4),
            ops_row(ops="LOBREAD", lobtype="TEMPORARY LOB", bytes=4, tim=1, line=5),
        ],
    )
    got = [r["rendered"] for r in render_line(df).orderBy("line").collect()]
    assert got[0] == "#100: WAIT  nam='x' ela= 1 a tim=2"
    assert got[1] == "#100: EXEC c=3,e=0,p=0,cr=0,cu=0,mis=0,r=0,dep=0,og=0,plh=0,tim=9,fname=f,line=2"
    assert got[2] == "XCTEND rlbk=0, rd_only=1, tim=0"
    assert got[3] == "*** CLIENT ID:(c) "
    assert got[4] == "LOBREAD: type=TEMPORARY LOB,bytes=4,c=0,e=0,p=0,cr=0,cu=0,tim=1"


def test_utc_time(spark):
    texts = ["2023-05-19T05:28:00.339263+02:00", "2023-05-19T05:28:00.5", "2023-05-19T05:28:00.1-00:30", "no"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r[0]) for r in df.selectExpr(utc_time("t")).collect()]
    assert got == ["2023-05-19 03:28:00.339263", "2023-05-19 05:28:00.500000", "2023-05-19 05:58:00.100000", "None"]
    local = df.selectExpr(utc_time("t", "Europe/Berlin")).collect()[1][0]
    assert str(local) == "2023-05-19 03:28:00.500000"


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.trc").write_text(traces.SIMPLE)
    args = (spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state"))
    stream_ingest(*args).awaitTermination()
    assert read_ops(spark, str(tmp_path / "out")).count() == 18
    (folder / "b.trc").write_text(traces.SIMPLE)
    stream_ingest(*args).awaitTermination()
    out = read_ops(spark, str(tmp_path / "out"))
    assert out.count() == 36
    assert out.groupBy("file_name").count().count() == 2
