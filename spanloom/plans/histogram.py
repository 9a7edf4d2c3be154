"""Latency histograms with one significant digit, and their percentile distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.buckets import bucket_high, bucket_low
from spanloom.plans.views import span_elapsed

# Fixed values of the public histogram format at one significant digit: 32 sub-buckets (5 bits), and
# 26 powers of two for its usual range 1 .. 1,000,000,000. Larger values have powers of two of their own.
SUB_BUCKET_BITS = 5
BUCKETS = 26
SUB_BUCKETS = 32
TICKS_PER_HALF_DISTANCE = 5


def hdr_histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts per log-linear bucket: ``keys, value_low, value_high, count``.

    All values count, negative ones in the mirror images of the buckets; NULL is no value. At most
    1,900 rows per key, combined map side, whatever the number of values.
    """
    low = bucket_low("abs(_v)", SUB_BUCKET_BITS)
    high = bucket_high("_low", SUB_BUCKET_BITS)
    return (
        df.selectExpr(*keys, f"cast({value} as bigint) as _v")
        .where("_v is not null")
        .groupBy(*keys, F.expr(f"{low} as _low"), F.expr("_v < 0 as _below"))
        .agg(F.expr("count(*) as count"))
        .selectExpr(
            *keys,
            f"if(_below, -({high}), _low) as value_low",
            f"if(_below, -_low, {high}) as value_high",
            "count",
        )
    )


def _ladder() -> Column:
    """Percentile levels: five steps to half of the remaining distance to 100, then again."""
    return F.expr(
        f"transform(sequence(0, {46 * TICKS_PER_HALF_DISTANCE - 1}), i -> "
        f"100D - 100D / power(2D, i div {TICKS_PER_HALF_DISTANCE}) "
        f"+ (i % {TICKS_PER_HALF_DISTANCE}) * 10D / power(2D, i div {TICKS_PER_HALF_DISTANCE}))"
    )


def percentile_distribution(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, value, percentile, total_count, inverse``: one row per reported percentile level.

    Every level of the ladder is met by the first bucket whose cumulative share reaches it; the
    ladder ends with the first level met by the last bucket, then comes the row of 100 %.
    """
    of_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    so_far = of_key.orderBy("value_low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = histogram.select(
        *keys,
        F.col("value_high").alias("value"),
        F.sum("count").over(so_far).alias("total_count"),
        F.sum("count").over(of_key).alias("_all"),
        F.col("count").alias("_here"),
    )
    share = F.lit(100.0) * F.col("total_count") / F.col("_all")
    before = F.when(F.col("total_count") == F.col("_here"), F.lit(-1.0)).otherwise(
        F.lit(100.0) * (F.col("total_count") - F.col("_here")) / F.col("_all")
    )
    is_last = F.col("total_count") == F.col("_all")
    ladder = cumulative.withColumn("_share", share).withColumn("_before", before)
    met = F.filter(_ladder(), lambda x: (x > F.col("_before")) & (x <= F.col("_share")))
    levels = F.when(is_last, F.concat(F.slice(met, 1, 1), F.array(F.lit(100.0)))).otherwise(met)
    out = ladder.select(*keys, "value", "total_count", F.explode(levels).alias("_level"))
    percentile = F.col("_level") / F.lit(100.0)
    return out.select(
        *keys,
        "value",
        percentile.alias("percentile"),
        "total_count",
        F.when(F.col("_level") < 100.0, F.lit(1.0) / (F.lit(1.0) - percentile)).alias("inverse"),
    )


def histogram_summary(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, standard deviation, highest value and total count, from bucket middles."""
    half = F.call_function("div", F.col("value_high") - F.col("value_low") + 1, F.lit(2))
    mid = (F.col("value_low") + half).cast("double")
    n = F.sum("count")
    mean = F.sum(mid * F.col("count")) / n
    squares = F.sum(mid * mid * F.col("count")) / n
    return histogram.groupBy(*keys).agg(
        mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), squares - mean * mean)).alias("std_deviation"),
        F.max("value_high").alias("max"),
        n.alias("total_count"),
    )


def histogram(
    ops: DataFrame,
    sql_ids: str | list[str] | None = None,
    wait_name: str | None = None,
    where: Column | None = None,
    remove_idle: bool = False,
    across_files: bool = False,
) -> DataFrame:
    """Histogram of execution times per statement, or of one wait event (column ``name``)."""
    if (sql_ids is None) == (wait_name is None):
        raise ValueError("give either sql_ids or wait_name")
    if wait_name is not None:
        rows = ops.where((F.col("ops") == "WAIT") & (F.col("event_name") == wait_name)).select(
            F.col("event_name").alias("name"), F.col("elapsed_time").alias("_value")
        )
    else:
        ids = sql_ids.split(",") if isinstance(sql_ids, str) else list(sql_ids)
        spans = span_elapsed(ops.where(F.col("sql_id").isin(ids)), remove_idle, across_files)
        if where is not None:
            spans = spans.where(where)
        rows = spans.select(F.col("sql_id").alias("name"), F.col("ela").alias("_value"))
    return hdr_histogram(rows, ["name"], "_value")


def percentile_lines(histogram: DataFrame, key: str) -> DataFrame:
    """The text form of the distribution: ``key, position, value`` with one row per line."""
    head = F.format_string(
        "%12s %14s %10s %14s", F.lit("Value"), F.lit("Percentile"), F.lit("TotalCount"),
        F.lit("1/(1-Percentile)"),
    )
    row = [F.col("value").cast("double"), F.col("percentile"), F.col("total_count")]
    body = percentile_distribution(histogram, [key]).select(
        key,
        (F.lit(1.0) + F.col("percentile")).alias("position"),
        F.when(
            F.col("inverse").isNull(), F.format_string("%12.1f %2.12f %10d", *row)
        )
        .otherwise(F.format_string("%12.1f %2.12f %10d %14.2f", *row, "inverse"))
        .alias("value"),
    )
    totals = histogram_summary(histogram, [key])
    foot = totals.select(
        key,
        F.posexplode(
            F.array(
                head,
                F.lit(""),
                F.format_string(
                    "#[Mean    = %12.1f, StdDeviation   = %12.1f]", "mean", "std_deviation"
                ),
                F.format_string(
                    "#[Max     = %12.1f, Total count    = %12d]",
                    F.col("max").cast("double"),
                    "total_count",
                ),
                F.format_string(
                    "#[Buckets = %12d, SubBuckets     = %12d]",
                    F.greatest(F.lit(BUCKETS), F.length(F.bin("max")) - SUB_BUCKET_BITS + 1),
                    F.lit(SUB_BUCKETS),
                ),
            )
        ).alias("_n", "value"),
    ).select(
        key,
        F.when(F.col("_n") < 2, F.col("_n") * 0.1).otherwise(F.col("_n") + 1.0).alias("position"),
        "value",
    )
    return body.unionByName(foot)


def write_percentiles(histogram: DataFrame, key: str, path: str) -> None:
    """One text file per key under ``path``, in the format of the public histogram plotter."""
    (
        percentile_lines(histogram, key)
        .repartition(key)
        .sortWithinPartitions(key, "position")
        .select(key, "value")
        .write.partitionBy(key)
        .text(path)
    )
