"""Centroid clustering against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from spanloom.llm.centroid import Bisectors, cluster, integer_vectors
from tests.llm.tables import crowded

KIND = "vec_id long, embedding array<double>"


def _plain(rows, k, rounds, dims):
    """Nearest centroids by all distances; exact floors of the means."""
    kept = [(i, [c.as_integer_ratio()[0] * 1024 // c.as_integer_ratio()[1] for c in v])
            for i, v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [
            [sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else own for i, own in enumerate(centroids)
        ]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {c: sum(d for _, own, d in placed if own == c) for _, c, _ in placed}
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), ",".join(map(str, centroids[c]))) for i, c, d in placed), key=repr
    )


def _got(df):
    return sorted(((*r[:5], ",".join(r[5])) for r in df.collect()), key=repr)


def _vectors(seed, count, dims, spread=0.3):
    pick = random.Random(seed)
    centres = [[pick.uniform(-2, 2) for _ in range(dims)] for _ in range(6)]
    return [(i, [c + pick.gauss(0, spread) for c in centres[i % 6]]) for i in range(count)]


@pytest.mark.parametrize("dims,rounds", [(64, 10), (3, 4), (1, 2)])
def test_equals_all_distances(spark, dims, rounds):
    rows = _vectors(dims, 300, dims)
    rows += [(400 + i, rows[7][1]) for i in range(100)] + [(7, rows[7][1])]  # copies, and a repeated row
    rows += [(600, None), (601, [0.5] * (dims + 1)), (602, [float("nan")] * dims), (603, [float("inf")] * dims), (604, [None] * dims), (605, []), (None, [0.25] * dims)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    assert _got(cluster(df, dims=dims, rounds=rounds)) == _plain(rows, 8, rounds, dims)


def test_ties_and_equal_centroids_keep_the_smaller_number(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)] + [(50 + i, [0.5, 0.0]) for i in range(3)]
    assert _got(cluster(spark.createDataFrame(rows, KIND), dims=2)) == _plain(rows, 8, 10, 2)
    pairs = Bisectors([[0, 0], [2, 0], [0, 0], [0, 2]])
    nearest, distance = pairs.nearest(np.array([[1, 0], [0, 1], [1, 1], [5, 0]], np.int64))
    assert nearest.tolist() == [0, 0, 0, 1] and distance.tolist() == [1, 1, 2, 9]


def test_components_of_any_size(spark):
    rows = [*_vectors(2, 40, 3), (90, [1e300, -1e300, 0.0]), (91, [1e6, -3e7, 2.5]), (92, [5e-324, -5e-324, 1e306])]
    got = _got(cluster(spark.createDataFrame(rows, KIND).repartition(3), dims=3))
    want = [
        (i, c, *(v if abs(v) < 1 << 63 else None for v in numbers), said) for i, c, *numbers, said in _plain(rows, 8, 10, 3)
    ]
    assert got == sorted(want, key=repr)


def test_few_and_no_vectors_and_other_columns(spark):
    rows = _vectors(4, 3, 64)
    few = spark.createDataFrame(rows, KIND)
    assert _got(cluster(few)) == _plain(rows, 8, 10, 64)
    more = crowded(few).withColumnRenamed("_n", "_ints").withColumnRenamed("score", "cluster").withColumnRenamed("size", "centroid")
    assert _got(cluster(more)) == _got(cluster(few))
    assert cluster(few.where("false")).collect() == []
    floats = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert integer_vectors(floats, "vec_id", "embedding", 64, 1024).where("_ints is null").count() == 0
