"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.sources.stage import stage, unstage


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, root)``: for each node of ``links`` (columns ``a``, ``b``, integers) the smallest one that
    links lead to. A node without links, and an empty table, give no rows.

    Every step makes the paths shorter and keeps one link a node at most in the end, so the number of
    steps grows with the logarithm of the longest path. Steps are tables, not recomputed; those of the
    step before are removed.
    """

    def table(df: DataFrame) -> DataFrame:
        return stage(df, name, drop_shuffles=True)

    edges = table(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = table(large)
        done = [edges, low, large]
        low = table(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = table(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct())
        unstage(*done, low)
        before, state = state, _digest(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
