"""The stored histogram against the one made from all rows, for ranges of hours, tries and compactions."""

import pytest
from pyspark.sql import functions as F

from spanloom.plans.histogram import hdr_histogram, histogram
from spanloom.plans.histogram_table import KINDS, add_batch, compact, hours_histogram


def _ops(spark):
    return spark.range(6000).selectExpr(
        "id div 3 as span_id", "'f' as file_name", "if(id div 3 % 11 = 0, null, concat('q', id div 3 % 4)) as sql_id", "concat('#', 100 + id % 9) as cursor_id",
        "if(id % 3 = 2, 'WAIT', 'EXEC') as ops", "concat('w', id % 2) as event_name", "id as line", "(id % 3) * (id div 3 * id div 3) + 1 as tim",
        "(id * 7919) % 100000 - 5 as elapsed_time", "'c' as client_id", "0 as cpu_time",
        "if(id div 3 % 50 = 7, null, timestamp_ntz'2024-01-01 00:30:00' + make_dt_interval(0, 0, 0, id div 3 * 300 + id % 3)) as ts",
    )


def _rows(df):
    return sorted(map(repr, df.select("name", "value_low", "value_high", "count").collect()))


def test_ranges_equal_the_histogram_of_all_rows(spark, tmp_path):
    ops, path = _ops(spark), str(tmp_path / "hours")
    for i in range(4):
        add_batch(ops.where(f"span_id % 4 = {i}"), path, f"b{i}")
    add_batch(ops.where("span_id % 4 = 2"), path, "b2")  # tried again
    for turn in range(3):
        for start, end in ((None, None), ("2024-01-02 00:00:00", "2024-01-04 07:00:00"), ("2024-01-03 05:00:00", None)):
            inside = F.lit(True)
            for limit, condition in ((start, F.col("ts").__ge__), (end, F.col("ts").__lt__)):
                inside = inside & (condition(F.to_timestamp_ntz(F.lit(limit))) if limit else F.lit(True)) & F.col("ts").isNotNull()
            want = histogram(ops, sql_ids="q0,q3", where=inside)
            assert _rows(hours_histogram(spark, path, "sql", start, end, "q0,q3")) == _rows(want)
            waits = ops.where("ops = 'WAIT'").where(inside).withColumn("name", F.col("event_name"))
            assert _rows(hours_histogram(spark, path, "wait", start, end)) == _rows(hdr_histogram(waits, ["name"], "elapsed_time"))
        if turn == 0:
            compact(spark, path)
        if turn == 1:  # a sum that was never stated counts for nothing
            spark.read.parquet(f"{path}/counts/batch=b1").write.parquet(f"{path}/counts/batch=total-lost")


def test_arguments(spark, tmp_path):
    path = str(tmp_path / "hours")
    add_batch(_ops(spark).where("false"), path, "empty")
    assert [hours_histogram(spark, path, kind).count() for kind in KINDS] == [0, 0]
    add_batch(_ops(spark), path, "one")
    for wrong in (lambda: add_batch(_ops(spark), path, "total-x"), lambda: hours_histogram(spark, path, "x")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(Exception, match="not on the hour"):
        hours_histogram(spark, path, "sql", "2024-01-01 00:30:00").collect()
