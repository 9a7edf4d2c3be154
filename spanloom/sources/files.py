"""Numbers for trace files: a dictionary that only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spanloom.sources.stage import stage

_FILES = "file_name string, file_number bigint"


def number_files(names: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``file_name, file_number`` of all distinct names: those of ``known`` keep their number, new ones follow in
    order of name.

    No window holds all names: they are range-sorted, and a number is the count of the ranges before plus the place
    in the range.
    """
    spark = names.sparkSession
    known = spark.createDataFrame([], _FILES) if known is None else known
    new = names.select("file_name").where("file_name is not null").distinct().join(known, "file_name", "left_anti")
    ranges = stage(new.repartitionByRange("file_name").selectExpr("file_name", "spark_partition_id() as _range"), "new_files")
    sizes = ranges.groupBy("_range").agg(F.expr("count(*) as _n"))
    starts = sizes.selectExpr(
        "_range", "coalesce(sum(_n) over (order by _range rows between unbounded preceding and 1 preceding), 0L) as _start"
    )
    first = known.agg(F.coalesce(F.max("file_number") + 1, F.lit(0).cast("long"))).scalar()
    place = F.expr("_start + row_number() over (partition by _range order by file_name) - 1")
    added = ranges.join(starts, "_range").select("file_name", (first + place).alias("file_number"))
    return known.select("file_name", "file_number").unionByName(added)


def file_dictionary(names: DataFrame, path: str) -> DataFrame:
    """Numbers of the files ``names`` from the dictionary at ``path``, to which those it lacks are added first.

    A name keeps its number for ever, so later runs and batches number other files differently and the same file
    alike. A run that is tried again finds what it added before. One writer at a time.
    """
    spark = names.sparkSession
    known = _read(spark, path)
    numbered = stage(number_files(names, known), "file_numbers")
    added = numbered if known is None else numbered.join(known, "file_name", "left_anti")
    if not added.isEmpty():
        added.write.mode("append").parquet(path)
    return numbered.join(names.select("file_name").distinct(), "file_name", "left_semi")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The dictionary as it is; of two numbers for a name, left by a writer that was cut off, the smaller one."""
    try:
        stored = spark.read.schema(_FILES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.groupBy("file_name").agg(F.min("file_number").alias("file_number"))
