"""Shards of nearly equal bytes whose groups stay together: longest processing time first.

Groups of equal keys go, largest first, to the least loaded shard of a heap. A group that holds more
than ``1 / (shards * GRAIN)`` of all bytes is a unit of its own; there can be no more than
``shards * GRAIN`` of these. The others are bundled by hash into ``2 * BUNDLES`` units, half of them a
fifteenth as large as the rest, so that the last units level what the large ones leave. The heap
therefore holds a fixed number of units however many documents there are, the map from unit to shard
is small enough to broadcast, and no row is moved to be assigned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.sources.stage import stage

GRAIN = 1024
BUNDLES = 4096


def longest_first(units: Iterable[tuple[object, int]], shards: int) -> dict[object, int]:
    """Unit -> shard. Ties between units go by their key, ties between shards by their number."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for unit, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, shard = heapq.heappop(heap)
        placed[unit] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Equal texts share a shard; a null text counts as an empty one (size 1). Sizes are UTF-8 bytes plus
    1. Slots number the rows of a shard from 0 without gaps. Null and repeated keys are rows like all
    others; other columns of ``docs`` are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    slim = stage(
        docs.select(
            F.col(key).alias("_key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("_group"),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard_rows",
    )
    groups = slim.groupBy("_group").agg(F.sum("size").alias("size"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    large = total // (shards * GRAIN) + 1
    place = F.pmod(F.xxhash64("_group", F.lit(1)), F.lit(16 * BUNDLES))
    bundle = F.when(place < 15 * BUNDLES, F.floor(place / 15)).otherwise(place - 14 * BUNDLES).cast("long")
    alone = groups.where(F.col("size") > large).collect()  # at most shards * GRAIN rows
    bundles = groups.where(F.col("size") <= large).groupBy(bundle.alias("b")).agg(F.sum("size").alias("size")).collect()
    units = [((1, r[0]), r[1]) for r in alone] + [((0, r["b"]), r["size"]) for r in bundles]
    placed = longest_first(units, shards)
    of_group = spark.createDataFrame([(u[1], s) for u, s in placed.items() if u[0] == 1], "_group long, _own int")
    of_bundle = spark.createDataFrame([(u[1], s) for u, s in placed.items() if u[0] == 0], "_bundle long, _shared int")
    put = (
        slim.withColumn("_bundle", bundle)
        .join(F.broadcast(of_group), "_group", "left")
        .join(F.broadcast(of_bundle), "_bundle", "left")
        .withColumn("shard", F.coalesce("_own", "_shared"))
        .select("_key", "size", "text_crc32", "shard", "_part", "_row")
    )
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        put.groupBy("shard", "_part")
        .count()
        .select("shard", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    )
    own = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_row")) - 1
    return (
        put.withColumn("_own", own)
        .join(base, ["shard", "_part"])
        .select(F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_base") + F.col("_own")).alias("slot"))
    )
