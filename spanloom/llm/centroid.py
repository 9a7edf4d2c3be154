"""Centroid clustering of integer vectors, exact from end to end.

Components become the integers ``floor(scale * x)``, and all later work is done on integers: neither the order
of rows nor the number of tasks changes a result.

* A vector finds its nearest centroid by a tournament: for centroids i < j the difference of the two squared
  distances is linear in x, ``2 (c_j - c_i) . x - (|c_j|^2 - |c_i|^2)``. Normals and thresholds of all pairs are
  computed once a round; the champion so far meets the next centroid and loses if the value is positive, so
  k - 1 sign tests leave the nearest one, and zero keeps the smaller number. Only its distance is computed.
* A round sends one row per task and centroid: count and component sums. They are merged by centroid, and the
  driver gets k rows. Sums are exact whole numbers of any size and travel as decimal text.
* Components below ``NARROW`` in size, all but freak ones, are 64-bit integers in matrices; vectors with larger
  ones take the same steps in Python's unbounded integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from spanloom.llm.rows import map_rows, nullable, slices
from spanloom.sources.stage import stage

NARROW = 1 << 24  # 4 * NARROW * NARROW * dimensions stays below 2**63 for up to 8,192 dimensions


class Bisectors:
    """Centroids with the normals and thresholds of all their pairs."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        narrow = all(abs(c) < NARROW for own in centroids for c in own)
        kind = np.int64 if narrow else object
        known = np.array(centroids, kind).reshape(len(centroids), len(centroids[0]) if centroids else 0)
        self.known, self.narrow = known, narrow
        self.normals = 2 * (known[None, :, :] - known[:, None, :])  # [i, j]: from i to j
        squares = (known * known).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, and the squared distance to it."""
        if vectors.dtype == object or not self.narrow:
            vectors = vectors.astype(object)
        champion = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.known)):
            value = (self.normals[champion, rival] * vectors).sum(axis=1) - self.thresholds[champion, rival]
            champion[(value > 0).astype(bool)] = rival
        apart = vectors - self.known[champion]
        return champion, (apart * apart).sum(axis=1)


def integer_vectors(rows: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``key``, ``_ints`` (64-bit integers, little-endian) or ``_wide`` (whole numbers of any size, as text) of
    the vectors with ``dims`` components that are all finite numbers. Other rows are left out."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where((F.size(vector) == dims) & F.coalesce(finite, F.lit(False)))
    kept = kept.select(F.col(key), values.alias("_values"))

    def whole():
        def one(x):
            if max(map(abs, x)) * scale < NARROW - 1:  # a power of two in practice: no rounding
                return np.floor(np.array(x) * scale).astype("<i8").tobytes(), None
            return None, ",".join(str(_floor(v, scale)) for v in x)

        return one

    return map_rows(kept, whole, ["_values"], "_ints binary, _wide string").drop("_values")


def _floor(value: float, scale: int) -> int:
    """Floor of the exact product."""
    top, bottom = value.as_integer_ratio()
    return top * scale // bottom


def _matrices(part: pa.RecordBatch, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places in the batch and vectors there: the narrow ones, then the wide ones."""
    ints, wide = part.column("_ints"), part.column("_wide")
    narrow = np.flatnonzero(ints.is_valid().to_numpy(zero_copy_only=False))
    other = np.flatnonzero(wide.is_valid().to_numpy(zero_copy_only=False))
    out = []
    if len(narrow):
        joined = b"".join(ints.drop_null().to_pylist())
        out.append((narrow, np.frombuffer(joined, "<i8").reshape(-1, dims)))
    if len(other):
        out.append((other, np.array([[int(c) for c in v.split(",")] for v in wide.drop_null().to_pylist()], object)))
    return out


def _round(vectors: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """Centroids after one round: floor of the mean of their vectors; those without vectors stay."""
    schema = nullable("cluster int, n string, sums string")
    arrow = to_arrow_schema(schema)

    def rows_of(totals):
        rows = [{"cluster": c, "n": str(n), "sums": ",".join(map(str, s))} for c, (n, s) in totals.items()]
        yield pa.RecordBatch.from_pylist(rows, arrow)

    def add(totals, cluster, n, sums):
        if cluster in totals:
            n, sums = n + totals[cluster][0], [a + b for a, b in zip(totals[cluster][1], sums, strict=True)]
        totals[cluster] = n, sums

    def local(batches):
        pairs, totals = Bisectors(centroids), {}
        for part in slices(batches, 4096):
            for _, matrix in _matrices(part, dims):
                nearest, _ = pairs.nearest(matrix)
                for c in np.unique(nearest).tolist():
                    own = matrix[nearest == c]
                    add(totals, c, len(own), [int(v) for v in own.sum(axis=0)])
        yield from rows_of(totals)

    def merge(batches):
        totals = {}
        for batch in batches:
            for row in batch.to_pylist():
                add(totals, row["cluster"], int(row["n"]), [int(s) for s in row["sums"].split(",")])
        yield from rows_of(totals)

    merged = vectors.select("_ints", "_wide").mapInArrow(local, schema).repartition(len(centroids), "cluster").mapInArrow(merge, schema)
    out = list(centroids)
    for row in merged.collect():  # one row a centroid
        out[row["cluster"]] = [int(s) // int(row["n"]) for s in row["sums"].split(",")]
    return out


def cluster(
    rows: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3", key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector with ``dims`` finite components: key, ``cluster`` (int), ``distance`` (squared, to the final
    centroid), ``cluster_inertia``, ``inertia`` (distances summed over the cluster and over all) and
    ``centroid``, the final centroid's components (array of decimal texts).

    The first centroids are the ``k`` vectors with the smallest hexadecimal SHA-256 of ``seed:key``, in that order;
    vectors of equal keys go by their components, those with a null key come last. Fewer vectors than ``k``: as
    many centroids. Equal centroids: the smaller number takes all. Every one of ``rounds`` rounds assigns all
    vectors to the nearest centroid (ties: the smaller number) and moves centroids to the floor of the mean;
    rounds that would change nothing are not run. A distance or sum beyond 64 bits is null. Repeated rows count
    as many times as they occur. No vector, or an empty table: no rows. Other columns are not read.
    """
    vectors = stage(integer_vectors(rows, key, vector, dims, scale), "integer_vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = vectors.orderBy(hashed.asc_nulls_last(), "_ints", "_wide").limit(k).collect()
    seeds = pa.RecordBatch.from_pylist([{"_ints": r["_ints"], "_wide": r["_wide"]} for r in first], pa.schema({"_ints": pa.binary(), "_wide": pa.string()}))
    centroids: list = [None] * len(first)
    for places, matrix in _matrices(seeds, dims):
        for at, own in zip(places.tolist(), matrix.tolist(), strict=True):
            centroids[at] = own
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, _round(vectors, centroids, dims)
        if centroids == before:
            break

    schema = nullable(f"{key} {vectors.schema[key].dataType.simpleString()}, cluster int, distance string")
    arrow = to_arrow_schema(schema)

    def assign(batches):
        pairs = Bisectors(centroids)
        for part in slices(batches, 4096):
            names = part.column(0)
            for places, matrix in _matrices(part, dims):
                nearest, distance = pairs.nearest(matrix)
                columns = [names.take(pa.array(places)).cast(arrow[0].type), pa.array(nearest, pa.int32()), pa.array([str(d) for d in distance.tolist()])]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    assigned = stage(vectors.select(key, "_ints", "_wide").mapInArrow(assign, schema), "assigned_vectors")
    whole = F.expr("try_cast(distance as decimal(38, 0))")
    fits = F.count("*") == F.count(whole)
    sums = assigned.groupBy("cluster").agg(F.sum(whole).alias("_sum"), fits.alias("_fits"))
    total = assigned.agg(F.when(fits, F.sum(whole)).alias("_all"))
    said = assigned.sparkSession.createDataFrame([(c, [str(v) for v in own]) for c, own in enumerate(centroids)], "cluster int, centroid array<string>")
    totals = sums.join(said, "cluster").withColumn("_all", total.scalar())
    return assigned.join(F.broadcast(totals), "cluster").select(  # a row a centroid
        key,
        "cluster",
        F.expr("try_cast(distance as long)").alias("distance"),
        F.expr("if(_fits, try_cast(_sum as long), null)").alias("cluster_inertia"),
        F.expr("try_cast(_all as long)").alias("inertia"),
        "centroid",
    )

