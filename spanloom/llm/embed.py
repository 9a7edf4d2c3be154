"""Near copies among embeddings through an inverted multi-index.

Two codebooks, one for each half of the vectors, form a grid of cells. A vector's own cell is that of its
nearest centroids. For another cell there is a bound of how near its vectors can be: the distances of
the two halves to the planes between centroids. Cells are visited nearest first, up to a slack, and all
vectors in them are compared. The slack is the least at which brute force over all rows, for a sample of
queries, finds ``recall`` of the links in every band of similarity, each query with the same say however
many links it has, and not less than four deviations of what a vector on the very
limit of the similarity is shifted by, in any one direction.

* Equal vectors are one vector with a weight from the start.
* A vector is sent once to each first-half centroid that it visits, together with its list of second
  halves. Large first halves are split into blocks, and visitors go to every block; a block is held, its
  visitors stream by.
* Links are not listed pair by pair: a task counts each visitor's links, and keeps for the components only
  as many as join its vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from spanloom.llm.graph import components
from spanloom.llm.rows import flat_map, hashed_sample, nullable
from spanloom.sources.stage import stage

BLOCK = 4096  # vectors of a block, about
SAMPLE = 20_000  # vectors that the codebooks are fitted on
QUERIES = 256  # vectors that the slack is measured with
BINS = 256
BANDS = 5  # of similarity, from the limit to 1
NORMAL = 1e-12


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; rows of zeros stay."""
    vectors = vectors.astype(np.float64)
    largest = np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    vectors = vectors / np.where(largest > 0, largest, 1)  # squares of tiny or huge numbers stay in range
    return vectors / np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), NORMAL)


def centroids(points: np.ndarray, count: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means; a centroid that loses all points stays where it is."""
    found = points[np.random.default_rng(seed).choice(len(points), count, replace=False)].copy()
    for _ in range(rounds):
        own = (found @ points.T - 0.5 * (found**2).sum(axis=1)[:, None]).argmax(axis=0)
        sums = np.zeros_like(found)
        np.add.at(sums, own, points)
        size = np.bincount(own, minlength=count)
        found[size > 0] = sums[size > 0] / size[size > 0, None]
    return found


class Grid:
    """Codebooks of the two halves."""

    def __init__(self, sample: np.ndarray, count: int):
        half = sample.shape[1] // 2
        self.cut = half
        self.books = [centroids(part, min(count, len(np.unique(part, axis=0)))) for part in (sample[:, :half], sample[:, half:])]

    def places(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each half: the nearest centroid, and the squared distances to the planes between its region
        and those of the other centroids."""
        found = []
        for book, part in zip(self.books, (vectors[:, : self.cut], vectors[:, self.cut :]), strict=True):
            apart = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            own = apart.argmin(axis=1)
            between = np.sqrt(np.maximum(((book[:, None] - book[None]) ** 2).sum(axis=-1), NORMAL))
            plane = np.maximum(apart - apart[np.arange(len(part)), own][:, None], 0) / (2 * between[own])
            plane[np.arange(len(part)), own] = 0
            found.append((own, plane**2))
        return found


def visits(first: np.ndarray, second: np.ndarray, slack: float) -> list[tuple[int, list[int]]]:
    """Cells of the grid in order of ``first + second`` up to ``slack``: first halves, nearest first, each
    with its second halves, nearest first."""
    order = np.argsort(second, kind="stable")
    steps = second[order]
    found = []
    for i in np.argsort(first, kind="stable"):
        if first[i] > slack:
            break
        found.append((int(i), order[: np.searchsorted(steps, slack - first[i], side="right")].tolist()))
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _slack(uniq: DataFrame, grid: Grid, limit: float, recall: float, width: int) -> float:
    """Squared slack at which the sample's links to all rows are found."""
    least = 16 * (2 - 2 * limit) / width
    rows = hashed_sample(uniq, QUERIES, "_node", seed=3).collect()
    queries = unit(np.array([r["_vector"] for r in rows], np.float64))
    names = np.array([r["_node"] for r in rows])
    (_, first), (_, second) = grid.places(queries)
    top = 2 - 2 * limit  # beyond it no cell can hold a link

    def measure():
        def some(part: pa.RecordBatch):
            vectors = unit(_matrix(part.column(1)))
            alike = queries @ vectors.T
            near = alike >= limit
            near &= names[:, None] != part.column(0).to_numpy()[None, :]
            q, v = np.nonzero(near)
            if not len(q):
                return None
            (own_first, _), (own_second, _) = grid.places(vectors)
            need = first[q, own_first[v]] + second[q, own_second[v]]
            bins = np.minimum(np.ceil(need / top * BINS), BINS).astype(np.int64)
            band = np.clip((alike[q, v] - limit) / max(1 - limit, NORMAL) * BANDS, 0, BANDS - 1).astype(np.int64)
            found, count = np.unique((q * BANDS + band) * (BINS + 1) + bins, return_counts=True)
            return found.tolist(), count.tolist()

        return some

    found = flat_map(uniq.select("_node", "_vector"), measure, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((len(rows), BANDS, BINS + 1))
    for row in found:
        counts.flat[row["b"]] = row["n"]
    shares = (counts / np.maximum(counts.sum(axis=2, keepdims=True), 1)).sum(axis=0)  # of each query's links
    reached = np.cumsum(shares, axis=1)
    enough = max(int(np.searchsorted(band, recall * band[-1])) for band in reached)
    return max(least, top * enough / BINS)


def near_vectors(
    table: DataFrame, limit: float = 0.95, recall: float = 0.999, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per row of ``table``: key, ``n_links``, ``component_id``, ``kept``.

    Linked are other rows of a cosine of ``limit`` or more. Null and zero vectors, and those with a null
    or non-finite component, link with nothing. Vectors of different lengths don't link; each length is
    searched on its own. A row with a null key counts as a link of others, but gives no component its
    name. Rows that repeat a key are rows of their own. Other columns are not read.
    """
    spark = table.sparkSession
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    value = F.when(F.coalesce(fine, F.lit(False)), F.transform(F.col(vector), lambda x: x.cast("double") + 0.0))
    rows = table.select(F.col(key).alias("_key"), value.alias("_vector")).withColumn(
        "_node", F.when(F.col("_vector").isNotNull(), F.xxhash64("_vector"))
    )
    same = rows.where("_node is not null").groupBy("_node").agg(F.first("_vector").alias("_vector"), F.count("*").alias("_weight"), F.min("_key").alias("_first"))
    same = stage(same, "vectors")
    lengths = same.groupBy(F.size("_vector").alias("_size")).count().where("count > 1").orderBy(F.desc("count"), "_size").collect()
    wide = [r for r in lengths if r["_size"] > 1]
    large = [r for i, r in enumerate(wide) if not i or r["count"] > BLOCK]
    parts = [_links(same.where(F.size("_vector") == r["_size"]), r, limit, recall) for r in large]
    if len(wide) > len(large):
        parts.append(_all_pairs(same.where(~F.size("_vector").isin(1, *(r["_size"] for r in large))), limit))
    if len(wide) < len(lengths):
        parts.append(_signs(same.where(F.size("_vector") == 1)))
    found = spark.createDataFrame([], "a long, b long, n long")
    for part in parts:
        found = found.unionByName(stage(part, "vector_links"))
    counts = found.groupBy("a").agg(F.sum("n").alias("_others")).withColumnRenamed("a", "_node")
    roots = components(found.where("b is not null").select("a", "b"), "vector_components").withColumnRenamed("node", "_node")
    known = same.select("_node", "_weight", "_first").join(counts, "_node", "left").join(roots, "_node", "left")
    known = stage(known.withColumn("_root", F.coalesce("root", "_node")), "vector_groups")
    named = stage(known.groupBy("_root").agg(F.min("_first").alias("_component")), "vector_names")
    known = known.join(named, "_root").select("_node", "_component", (F.col("_weight") - 1 + F.coalesce("_others", F.lit(0))).alias("_n"))
    component = F.when(F.col("_node").isNull(), F.col("_key")).otherwise(F.col("_component"))
    return (
        rows.select("_key", "_node")
        .join(stage(known, "vector_results"), "_node", "left")
        .select(F.col("_key").alias(key), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
    )


def _links(same: DataFrame, most: dict, limit: float, recall: float) -> DataFrame:
    """``(a, b, n)``: links of ``a`` found in one block (their weight), and one of them; further rows with
    ``n`` 0 join vectors of the block that share a visitor."""
    spark = same.sparkSession
    context = spark.sparkContext
    sample = hashed_sample(same, SAMPLE, "_node", seed=2).select("_vector").collect()
    per_half = int(max(2, min(1024, round(most["count"] ** 0.5 / 4))))
    grid = Grid(unit(np.array([r[0] for r in sample], np.float64)), per_half)
    slack = _slack(same, grid, limit, recall, most["_size"])
    shared = context.broadcast(grid)

    def place():
        own = shared.value

        def some(part: pa.RecordBatch):
            (first, _), _ = own.places(unit(_matrix(part.column(0))))
            return (first.tolist(),)

        return some

    sizes = {r["h"]: r["count"] for r in flat_map(same.select("_vector"), place, "h int").groupBy("h").count().collect()}
    blocks = {h: -(-n // BLOCK) for h, n in sizes.items()}

    def deal():
        own = shared.value

        def some(part: pa.RecordBatch):
            names, weights = (part.column(c).to_pylist() for c in ("_node", "_weight"))
            vectors = part.column("_vector").to_pylist()
            (first, to_first), (second, to_second) = own.places(unit(_matrix(part.column("_vector"))))
            out = [[], [], [], [], [], []]
            for i, name in enumerate(names):
                home = int(first[i])
                rows = [(home, name % blocks[home], 0, [int(second[i])])]
                for h, cells in visits(to_first[i], to_second[i], slack):
                    rows += [(h, b, 1, cells) for b in range(blocks.get(h, 0))]
                for h, b, role, cells in rows:
                    for column, v in zip(out, (h * 1_000_000 + b, role, name, weights[i], vectors[i], cells), strict=True):
                        column.append(v)
            return out

        return some

    dealt = flat_map(same.select("_node", "_weight", "_vector"), deal, "_block long, _role int, _node long, _weight long, _vector array<double>, _cells array<int>")
    return _compared(dealt, limit)


def _all_pairs(same: DataFrame, limit: float) -> DataFrame:
    """Links as ``_links`` gives them, of lengths with few vectors: a block holds all of a length."""
    role = F.explode(F.array(F.lit(0), F.lit(1))).alias("_role")
    return _compared(
        same.select(F.size("_vector").cast("long").alias("_block"), role, "_node", "_weight", "_vector", F.array(F.lit(0)).alias("_cells")), limit
    )


def _signs(same: DataFrame) -> DataFrame:
    """Links as ``_links`` gives them, of vectors of length 1: those of the same sign link."""
    signed = same.select("_node", "_weight", (F.col("_vector")[0] > 0).alias("_sign"))
    groups = signed.groupBy("_sign").agg(F.sum("_weight").alias("_all"), F.min("_node").alias("_low"), F.max("_node").alias("_high"))
    return signed.join(F.broadcast(groups.where("_low < _high")), "_sign").select(
        F.col("_node").alias("a"), F.when(F.col("_node") == F.col("_low"), F.col("_high")).otherwise(F.col("_low")).alias("b"), (F.col("_all") - F.col("_weight")).alias("n")
    )


def _compared(dealt: DataFrame, limit: float) -> DataFrame:
    dealt = dealt.repartition("_block").sortWithinPartitions("_block", "_role")
    schema = nullable("a long, b long, n long")
    arrow = to_arrow_schema(schema)

    def compare(batches):
        block, held = None, None
        for batch in batches:
            numbers, roles = (batch.column(c).to_numpy() for c in ("_block", "_role"))
            edges = np.flatnonzero(np.diff(numbers) | np.diff(roles)) + 1
            out = []
            for start, stop in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if start == stop:
                    continue
                part = batch.slice(start, stop - start)
                if numbers[start] != block:
                    block, held = numbers[start], _Block()
                if roles[start] == 0:
                    held.add(part)
                else:
                    held.compare(part, limit, out)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return dealt.mapInArrow(compare, schema)


class _Block:
    """Vectors of one first half, in order of their second half."""

    def __init__(self):
        self.parts, self.ready = [], False

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def _sort(self) -> None:
        names, weights = (np.concatenate([p.column(c).to_numpy() for p in self.parts]) for c in ("_node", "_weight"))
        vectors = unit(np.concatenate([_matrix(p.column("_vector")) for p in self.parts]))
        cells = np.concatenate([p.column("_cells").flatten().to_numpy() for p in self.parts])
        order = np.argsort(cells, kind="stable")
        self.names, self.weights, self.vectors = names[order], weights[order], vectors[order]
        self.starts = np.searchsorted(cells[order], np.arange(cells.max() + 2)).tolist()
        self.root = np.arange(len(order))
        self.ready, self.parts = True, []

    def compare(self, part: pa.RecordBatch, limit: float, out: list) -> None:
        if not self.ready:
            if not self.parts:
                return
            self._sort()
        vectors = unit(_matrix(part.column("_vector")))
        for name, vector, cells in zip(part.column("_node").to_pylist(), vectors, part.column("_cells").to_pylist(), strict=True):
            spans = [(self.starts[c], self.starts[c + 1]) for c in cells if c + 1 < len(self.starts)]
            places = np.concatenate([np.arange(i, j) for i, j in spans if i < j] or [np.zeros(0, np.int64)])
            near = places[self.vectors[places] @ vector >= limit]
            near = near[self.names[near] != name]
            if not len(near):
                continue
            out.append((name, int(self.names[near[0]]), int(self.weights[near].sum())))
            roots = np.unique(self.root[near])
            if len(roots) > 1:
                out += [(int(self.names[r]), int(self.names[roots[0]]), 0) for r in roots[1:]]
                self.root[np.isin(self.root, roots)] = roots[0]
