"""Filters of hashes in either of the forms that tasks send; shuffle files behind staged tables."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import sketch
from spanloom.sources.stage import stage


@pytest.mark.parametrize("size", [0, 1, 300, sketch.SLICE // 32 - 1, sketch.SLICE // 32, 40_000])
def test_both_forms_of_a_slice_hold_the_same_bits(size):
    codes = np.random.default_rng(size).integers(0, 1 << 32, size, dtype=np.uint32)
    packed = sketch._packed(codes)
    assert len(packed) <= min(4 * size, sketch.SLICE // 8)
    assert (sketch._plane(packed) == sketch._filled(codes)).all()


@pytest.mark.parametrize("rows", [3000, 60_000])
def test_a_filter_of_repeats_misses_none_and_keeps_few_others(spark, rows):
    table = spark.range(rows).selectExpr("explode(if(id % 10 = 0, array(id, id), array(id))) as id").repartition(5)
    hashed = table.select(F.xxhash64("id"))

    def hashes():
        return lambda part: np.array(part.column(0), np.int64).view(np.uint64)

    planes = sketch.bloom(hashed, hashes, sketch.slices_for(rows), twice=True)
    every = spark.range(rows).select("id", F.xxhash64("id").alias("hash")).toArrow()
    found = sketch.contains(planes, every["hash"].to_numpy().view(np.uint64))
    repeated = every["id"].to_numpy() % 10 == 0
    assert found[repeated].all() and found[~repeated].mean() < 0.05


def test_counts_of_any_size(spark):
    table = spark.range(70_000).select(F.lit(1).alias("value"))
    counts, rows = sketch.row_counts(table, lambda: lambda value: np.array([7, sketch.CELLS + 1], np.uint64), 2 * sketch.CELLS)
    assert rows == 70_000 and np.flatnonzero(counts).tolist() == [7, sketch.CELLS + 1] and set(counts[counts > 0]) == {70_000}


def test_shuffle_files_go_with_the_table(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    assert spark.conf.get(setting, None) is None
    before = shuffles()
    held = spark.range(100_000).repartition(6, "id")  # stays reachable, so that nothing but the write removes files
    table = stage(held, "moved", drop_shuffles=True)
    until = time.time() + 30
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not {n for n in shuffles() - before if n.endswith(".data")}
    assert table.count() == held.count() == 100_000
    assert spark.conf.get(setting, None) is None
