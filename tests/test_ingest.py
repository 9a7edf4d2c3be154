"""Trace files to fact table: one ingest of several files, in all codecs."""

import bz2
import datetime as dt
import gzip
import lzma
import os

import pytest
from pyspark.sql import functions as F

from spanloom.plans.ingest import ingest, ingest_stats
from spanloom.sources import trace
from spanloom.sources.store import read_ops
from spanloom.sources.trace import read_lines
from spanloom.streaming.ingest import stream_ingest
from tests import traces


def _name(row):
    return row["file_name"].rsplit("/", 1)[1]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("traces")
    for name, text in (("simple", traces.SIMPLE), ("again", traces.AGAIN), ("odd", traces.ODD)):
        (folder / f"{name}.trc").write_text(text)
    data = traces.SIMPLE.encode()
    (folder / "packed.trc.gz").write_bytes(gzip.compress(data))
    (folder / "packed.trc.bz2").write_bytes(bz2.compress(data))
    (folder / "packed.trc.xz").write_bytes(lzma.compress(data[:300]) + lzma.compress(data[300:]))
    (folder / "packed.trc.lzma").write_bytes(lzma.compress(data, format=lzma.FORMAT_ALONE))
    return folder


@pytest.fixture(scope="module")
def result(spark, files):
    lines = read_lines(
        spark, [str(files / p) for p in ("*.trc", "*.gz", "*.bz2", "*.xz", "*.lzma")]
    )
    done = ingest(lines, ids="dense", attach_lobs=False)
    rows = {}
    for r in done.ops.collect():
        rows.setdefault(_name(r), []).append(r)
    for found in rows.values():
        found.sort(key=lambda r: r["line"])
    return done, rows, lines


NUMBERS = [
    "EXEC #10:c=1,e=9223372036854775807,tim=5",
    "EXEC #10:c=1,e=9223372036854775808,tim=5",
    "EXEC #10:c=1,e=2,mis=2147483647,tim=5",
    "EXEC #10:c=1,e=2,mis=2147483648,tim=5",
    "ERROR #10:err=942 tim=9999999999999999999",
    "WAIT #10: nam='x' ela= 9223372036854775807 p1=1 tim=5",
    "WAIT #10: nam='x' ela= 9223372036854775808 p1=1 tim=5",
    "EXEC #10:c=1,e=0000000000000000000000002,tim=5",
]


def test_large_numbers_are_kept_or_rejected(spark):
    rows = [("f", i + 4, v) for i, v in enumerate(NUMBERS)]
    done = ingest(spark.createDataFrame(rows, "file_name string, line bigint, value string"))
    assert {r["line"]: r["elapsed_time"] for r in done.ops.collect()} == {4: 2**63 - 1, 6: 2, 9: 2**63 - 1, 11: 2}
    found = {(r["line"], r["reason"]) for r in done.rejects.collect()}
    assert found == {(line, "range") for line in (5, 7, 8, 10)}


def test_every_codec_gives_the_same_rows(result):
    _, rows, _ = result
    plain = [r.asDict() for r in rows["simple.trc"]]
    assert len(plain) == 3 + 5 + 9 + 1  # headers, stars, calls, commit
    for name in ("packed.trc.gz", "packed.trc.bz2", "packed.trc.xz", "packed.trc.lzma"):
        other = [r.asDict() for r in rows[name]]
        for a, b in zip(plain, other, strict=True):
            assert {k: v for k, v in a.items() if k not in ("file_name", "span_id")} == {
                k: v for k, v in b.items() if k not in ("file_name", "span_id")
            }


def test_simple_interaction(result):
    _, rows, _ = result
    calls = [r for r in rows["simple.trc"] if r["cursor_id"]]
    assert [r["ops"] for r in calls] == [
        "PIC", "PARSE", "BINDS", "EXEC", "WAIT", "FETCH", "FETCH", "STAT", "CLOSE",
    ]
    assert len({r["span_id"] for r in calls}) == 1
    assert {r["sql_id"] for r in calls} == {"stmt1"}
    assert sum(r["elapsed_time"] for r in calls) == 6 + 8 + 12 + 10 + 2 + 3
    assert sum(r["cpu_time"] for r in calls) == 5 + 7 + 9 + 1 + 1
    pic, parse, binds, _, wait, fetch = calls[:6]
    assert pic["event_raw"] == "select a\n  from b\n"
    assert (pic["len"], pic["uid"], pic["oct"], pic["hv"], pic["ad"]) == (20, 9, 3, 77, "ab12")
    assert (parse["cursor_missed"], parse["opt_goal"], parse["plh"]) == (1, 1, 99)
    assert binds["event_raw"] == " Bind#0\n  value=1\n" and binds["tim"] is None
    assert (wait["event_name"], wait["tim"]) == ("db file sequential read", 1050)
    assert wait["event_raw"].startswith(" nam='db file")
    assert (fetch["ph_reads"], fetch["cr_reads"], fetch["rows_processed"]) == (1, 4, 3)
    assert calls[-1]["c_type"] == 2


def test_dense_ids_follow_closing_order(result):
    """Records outside of cursors are numbered as they come, open spans at the end of their file."""
    _, rows, _ = result
    found = rows["simple.trc"]
    first = min(r["span_id"] for r in found)
    outside = [r["span_id"] - first for r in found if not r["cursor_id"]]
    assert outside == list(range(len(outside)))
    assert {r["span_id"] - first for r in found if r["cursor_id"]} == {len(outside)}


def test_spans_without_parse_and_over_resets(result):
    _, rows, _ = result
    spans = {}
    for r in rows["again.trc"]:
        if r["cursor_id"]:
            spans.setdefault(r["span_id"], []).append((r["cursor_id"], r["ops"]))
    found = [[op for _, op in calls] for calls in spans.values()]
    assert ["EXEC"] in found and ["EXEC", "FETCH"] in found
    assert ["FETCH"] in found and ["WAIT"] in found and ["CLOSE"] in found
    assert len(found) == 6
    assert {r["sql_id"] for r in rows["again.trc"] if r["cursor_id"] == "#4711"} == {"stmt1"}
    assert {r["sql_id"] for r in rows["again.trc"] if r["cursor_id"] == "#0"} == {None}


def test_clock(result):
    _, rows, _ = result
    base = dt.datetime(2024, 3, 1, 9, 0, 0, 500)
    by_op = {r["ops"]: r["ts"] for r in rows["simple.trc"]}
    us = dt.timedelta(microseconds=1)
    assert by_op["HEADER"] is None
    assert by_op["PIC"] == base and by_op["PARSE"] == base + 10 * us
    assert by_op["BINDS"] == base + 10 * us  # no clock of its own
    assert by_op["STAT"] == base + 70 * us and by_op["XCTEND"] == base + 90 * us
    last = rows["again.trc"][-1]
    assert last["ops"] == "CLOSE" and last["ts"] == dt.datetime(2024, 3, 1, 9, 0, 5)


def test_context(result):
    _, rows, _ = result
    row = rows["simple.trc"][-1]
    assert (row["sid"], row["client_id"], row["module"], row["container_id"]) == (
        "12.34", "web", "shop", 3,
    )
    assert row["action"] is None and row["service_name"] is None
    odd = rows["odd.trc"][-1]
    assert (odd["client_id"], odd["action"]) == ("late", "pay")


def test_odd_lines(result):
    done, rows, _ = result
    odd = rows["odd.trc"]
    binds = next(r for r in odd if r["ops"] == "BINDS")
    assert binds["event_raw"] == " Bind#0\n  value=2\n"
    stars = [r["ts"] for r in odd if r["ops"] == "STAR"]
    assert dt.datetime(2024, 3, 1, 9, 0, 1) in stars
    assert dt.datetime(2024, 3, 1, 10, 0, 2) in stars  # without a zone: taken as UTC
    assert dt.datetime(2024, 3, 1, 9, 30, 3) in stars
    pic = next(r for r in odd if r["ops"] == "PIC")
    assert pic["event_raw"] == "select 1\n=====================\n"
    assert (pic["sql_id"], pic["rec_call_dp"], pic["ad"]) == ("", 0, "")
    error = next(r for r in odd if r["ops"] == "PARSE ERROR")
    assert (error["error_code"], error["event_raw"]) == (942, "selec bad\n=====================\n")
    wait = next(r for r in odd if r["ops"] == "WAIT")
    assert (wait["event_name"], wait["elapsed_time"], wait["tim"]) == ("", 0, None)
    lob = next(r for r in odd if r["ops"] == "LOBREAD")
    assert (lob["lobtype"], lob["bytes"], lob["cursor_id"], lob["sql_id"]) == (
        "TEMPORARY LOB", 5, None, None,
    )
    rejects = sorted(
        (r["line"], r["reason"]) for r in done.rejects.collect() if _name(r) == "odd.trc"
    )
    assert [reason for _, reason in rejects] == ["params", "cursor", "params", "params"]
    orphans = [r["value"] for r in done.orphans.collect() if _name(r) == "odd.trc"]
    assert sorted(orphans) == ["END OF STMT", "a line that no rule knows"]


def test_stats(result):
    done, _, lines = result
    stats = {_name(r): (r["lines"], r["errors"]) for r in ingest_stats(lines, done.rejects).collect()}
    assert stats["odd.trc"] == (len(traces.ODD.splitlines()), 4)
    assert stats["packed.trc.xz"] == (len(traces.SIMPLE.splitlines()), 0)


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    path = tmp_path / "long.trc"
    path.write_text("".join(f"line {i}\n" for i in range(1, 2001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = read_lines(spark, str(path))
        wrong = lines.where(F.concat(F.lit("line "), F.col("line")) != F.col("value"))
        assert lines.count() == 2000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("most", [1 << 20, 7])
def test_numbering_does_not_move_the_text(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(trace, "INDEX_ROWS", most)
    for name in "abc":
        (tmp_path / f"{name}.trc").write_text("".join(f"{name} {i}\n" for i in range(1, 901)))
    kept = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in kept}
    for k, v in kept.items():
        spark.conf.set(k, v)
    try:
        lines = read_lines(spark, str(tmp_path))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        if most > 7:
            assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        name = F.regexp_extract("file_name", "([abc])[.]trc", 1)
        assert lines.count() == 2700
        assert lines.where(F.concat(name, F.lit(" "), "line") != F.col("value")).count() == 0
        assert lines.where("line is null").count() == 0 and lines.where("file_name like '%b.trc'").count() == 900
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_two_streams_share_a_target(spark, tmp_path):
    for name, line in (("one", "EXEC #10:c=1,e=2,tim=3"), ("two", "EXEC #11:c=1,e=2,ti")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.trc").write_text("\n".join(["p"] * 3 + [line, "nothing known"]))
        for _ in range(2):  # the second run of a stream finds nothing new
            stream_ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / f"state_{name}")).awaitTermination()
    assert [r["cursor_id"] for r in read_ops(spark, str(tmp_path / "out")).collect()] == ["#10"]
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "out/_rejects")).collect()] == ["EXEC #11:c=1,e=2,ti"]
    assert spark.read.parquet(str(tmp_path / "out/_orphans")).count() == 2
    left = spark.conf.get("spark.checkpoint.dir") + "/spanloom"
    assert not [f for f in os.listdir(left) if f.endswith("-0")]
    with pytest.raises(ValueError):
        stream_ingest(spark, "f", "t", "c", ids="dense")
