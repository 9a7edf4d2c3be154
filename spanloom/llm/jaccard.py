"""Documents whose sets of word shingles have a Jaccard similarity of four fifths or more, and their groups.

Equal sets are one set from the start. A global order puts the rare shingles of each set first; then two
similar sets share one of their first ``n - ceil(t n) + 1`` shingles, and the join is made on these.

* Rarity is the number of documents on a hashed counter; any order that all sets share gives whole
  results, a better one only fewer candidates.
* A Bloom filter of the prefix shingles of two rows or more keeps the others, nearly all, from moving.
* Prefix shingles of at most ``SMALL`` sets, nearly all, have their pairs taken at once, under the length and
  positional filters: no more than half of ``SMALL`` pairs a set and shingle.
* Of the list of a longer one, the sets outside of its largest component are paired with ``LEADERS`` sets of that
  component, under the same filters; verified links make larger components. After
  ``ROUNDS`` such rounds the sets still outside are joined with all sets of the list that are in another
  component. So a group of copies, however large, is linked through few leaders and not paired with
  itself, and every pair that could join two components is verified.
* Sets carry parity bits: bit i tells whether an odd number of their shingles hash to i. Two sets differ in
  at least as many shingles as in bits, so most pairs that can't be similar are known by a few words.
* A pair is verified once, from the texts: a suffix filter bounds the common shingles before they are counted.
  Texts move for the pairs that the parity bits leave, a filter of their sets picks them.

Sets are named by 64-bit hashes of all their shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.filters import bloom_filter, may_hold
from spanloom.functions.filters import slices_for as core_slices
from spanloom.llm.graph import components
from spanloom.llm.rows import flat_map, map_rows
from spanloom.llm.sketch import bloom, contains, row_counts, slices_for
from spanloom.sources.stage import stage as _stage
from spanloom.sources.stage import unstage

COUNTERS = 1 << 22
ROUNDS = 2
SMALL = 8
BITS = 1024
LEADERS = 4
FEW = 2  # 64-bit integers of folded parity bits that travel with the lists
MORE = 8  # and with those that are joined at last


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    return _stage(df, name, drop_shuffles=True, **options)


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sorted distinct shingles of a text, as 64-bit hashes."""

    def __init__(self, words: int):
        self.width = words

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().translate(_LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        width = min(self.width, len(words))
        with np.errstate(over="ignore"):
            mixed = np.full(len(words) - width + 1, width, np.uint64)
            for k in range(width):
                mixed = (mixed ^ code[k : len(words) - width + 1 + k]) * _FACTOR
                mixed ^= mixed >> np.uint64(31)
        mixed.sort()
        first = np.ones(len(mixed), bool)
        first[1:] = mixed[1:] != mixed[:-1]
        return mixed[first]


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """``BITS`` parity bits as 64-bit integers."""
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rare shingles of a set by which a similar one must be found, in the global order."""
    rarity = counts[(shingles % np.uint64(len(counts))).astype(np.int64)]
    n = len(shingles)
    return shingles[np.lexsort((shingles, rarity))[: n - (4 * n + 4) // 5 + 1]]


def least_common(n: int, m: int) -> int:
    """Common shingles that sets of ``n`` and ``m`` need: 100 * common >= 80 * union."""
    return (4 * (n + m) + 8) // 9


def most_common(one: np.ndarray, other: np.ndarray, depth: int = 3) -> int:
    """Bound of the number of common values of two sorted arrays: the parts on either side of a middle
    value can't have more in common than the smaller part has."""
    if depth == 0 or len(one) < 2 or len(other) < 2:
        return min(len(one), len(other))
    middle = one[len(one) // 2]
    i, j = len(one) // 2, int(np.searchsorted(other, middle))
    return most_common(one[:i], other[:j], depth - 1) + most_common(one[i:], other[j:], depth - 1)


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    need = least_common(len(one), len(other))
    if min(len(one), len(other)) < need or most_common(one, other) < need:
        return False
    return len(np.intersect1d(one, other, assume_unique=True)) >= need


def _texts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """One text of each set of ``pairs``, and of few others, as a table."""
    ends = stage(pairs.select(F.explode(F.array("a", "b")).alias("_set")).distinct(), "paired_sets")
    slices = core_slices(ends.count())
    named = rows.where("_set is not null").select("_set", "_text")
    found = may_hold(named, ["_set"], bloom_filter(ends, ["_set"], slices), slices) if slices else named
    texts = stage(found.groupBy("_set").agg(F.first("_text").alias("_text")), "paired_texts", compression="zstd")
    unstage(ends)
    return texts


def _verified(pairs: DataFrame, bits: DataFrame, rows: DataFrame, words: int, name: str) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose sets are similar, as a table. The bits of all pairs are
    compared first, the texts of those that are left are brought together then."""
    left, right = (bits.select(F.col("_set").alias(c), F.col("_n").alias(f"_n{c}"), F.col("_bits").alias(f"_{c}")) for c in "ab")
    apart = "aggregate(zip_with(_a, _b, (x, y) -> bit_count(x ^ y)), 0, (sum, n) -> sum + n)"
    near = pairs.join(left, "a").join(right, "b").where(f"9 * {apart} <= _na + _nb").select("a", "b")
    near = stage(near, "near_pairs")
    texts = _texts(rows, near)

    def check():
        make = Shingles(words)

        def some(part: pa.RecordBatch):
            kept, last, own = [], None, None
            for a, b, one, other in zip(*(part.column(c).to_pylist() for c in ("a", "b", "_one", "_other")), strict=True):
                if b != last:
                    last, own = b, make(other)
                if similar(make(one), own):
                    kept.append((a, b))
            return [[k[0] for k in kept], [k[1] for k in kept]]

        return some

    one = texts.select(F.col("_set").alias("a"), F.col("_text").alias("_one"))
    other = texts.select(F.col("_set").alias("b"), F.col("_text").alias("_other"))
    found = stage(flat_map(near.join(one, "a").join(other, "b").select("a", "b", "_one", "_other"), check, "a long, b long"), name)
    unstage(near, texts)
    return found


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id`` (the smallest key that links lead to).

    Words are runs of other than white space, A-Z lower-cased; a text with fewer than ``words`` words has
    all of them as its one shingle, a null, empty or blank one has none and is linked with nothing.
    Repeated rows are equal texts. A row with a null key is linked by its text like others, but gives no
    component its name; alone it has a null component. Other columns are not read.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(text)
    counts = context.broadcast(row_counts(texts, lambda: Shingles(words), COUNTERS)[0])

    def prefixes():
        make = Shingles(words)

        def some(part: pa.RecordBatch):
            found = {}
            for value in part.column(0).to_pylist():
                shingles = make(value)
                found.setdefault(shingles.tobytes(), shingles)
            return np.concatenate([prefix(s, counts.value) for s in found.values()])

        return some

    size = F.octet_length(text)
    tokens = texts.agg(F.sum(size)).first()[0] or 0  # a shingle a word, a fifth of them prefix, over six bytes a word
    known = context.broadcast(bloom(texts, prefixes, slices_for(tokens // 24), twice=True))

    def describe():
        make = Shingles(words)

        def one(value):
            shingles = make(value)
            if not len(shingles):
                return 0, None, None, None, None, None
            name = xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
            own = prefix(shingles, counts.value)
            at = np.flatnonzero(contains(known.value, own))
            if not len(at):
                return len(shingles), name, None, None, None, None
            bits = parity_bits(shingles)
            few = np.bitwise_xor.reduce(bits.reshape(-1, FEW), axis=0)  # as if there were 64 * FEW bits
            return len(shingles), name, own[at].view(np.int64).tolist(), at.tolist(), bits.tolist(), few.tolist()

        return one

    rows = map_rows(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")),
        describe,
        ["_text"],
        "_n long, _set long, _tokens array<long>, _places array<int>, _bits array<long>, _few array<long>",
    )
    rows = stage(rows, "shingle_sets", compression="zstd")
    own = ["_n", "_tokens", "_places", "_bits", "_few"]
    sets = rows.where("size(_tokens) > 0").groupBy("_set").agg(*[F.first(c).alias(c) for c in own])
    sets = stage(sets, "candidate_sets")
    lists = sets.select("_set", "_n", "_few", F.explode(F.arrays_zip("_tokens", "_places")).alias("_t")).selectExpr(
        "_t._tokens as _token", "_set", "_n", "_t._places as _place", *[f"_few[{i}] as _few{i}" for i in range(FEW)]
    )
    shared = stage(lists.groupBy("_token").agg(F.count("*").alias("_sets")).where("_sets > 1"), "shared_shingles")
    few = lists.join(shared.where(f"_sets <= {SMALL}").select("_token"), "_token")
    lists = stage(lists.join(shared.where(f"_sets > {SMALL}").select("_token"), "_token"), "long_lists")
    bits = sets.select("_set", "_n", "_bits")

    def apart(count: int, name: str) -> str:
        return f"9 * ({' + '.join(f'bit_count(x.{name}{i} ^ y.{name}{i})' for i in range(count))}) <= x._n + y._n"

    need = f"4 * (x._n + y._n) <= 9 * least(x._n - x._place, y._n - y._place) and {apart(FEW, '_few')}"
    own = ["_set", "_n", "_place", *[f"_few{i}" for i in range(FEW)]]
    pair = [F.expr("greatest(x._set, y._set)").alias("a"), F.expr("least(x._set, y._set)").alias("b")]
    x, y = few.alias("x"), few.alias("y")
    small = x.join(y, F.expr(f"x._token = y._token and x._set < y._set and {need}")).select(pair).distinct()
    small = stage(small, "small_pairs")
    unstage(shared)
    links = tried = None
    for turn in range(ROUNDS + 1):
        if links is None:
            grouped = lists.withColumn("_root", F.col("_set"))
        else:
            roots = stage(components(links), "roots")
            links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # as good as the links so far
            roots = roots.withColumnRenamed("node", "_set")
            grouped = stage(lists.join(roots, "_set", "left").withColumn("_root", F.coalesce("root", "_set")).drop("root"), "grouped_lists")
        picks = [F.min(F.struct(F.xxhash64("_set", F.lit(LEADERS * turn + i)), *own)) for i in range(LEADERS)]
        largest = (
            grouped.groupBy("_token", "_root")
            .agg(F.count("*").alias("_sets"), F.array_distinct(F.array(*picks)).alias("_leaders"))
            .groupBy("_token")
            .agg(F.max(F.struct("_sets", "_root", "_leaders")).alias("_most"), F.count("*").alias("_roots"))
            .where("_roots > 1")
            .select("_token", F.col("_most._root").alias("_largest"), "_most._leaders")
        )
        largest = stage(largest, "largest_components")
        if turn < ROUNDS:
            leaders = largest.select("_token", "_largest", F.explode("_leaders").alias("_l")).select("_token", "_largest", "_l.*")
            x, y = grouped.alias("x"), leaders.alias("y")
            found = x.join(y, F.expr(f"x._token = y._token and x._root <> y._largest and {need}"))
        else:
            folded = ["^".join(f"_bits[{j}]" for j in range(i, BITS // 64, MORE)) + f" as _more{i}" for i in range(MORE)]
            inside = grouped.join(largest.select("_token", "_largest"), "_token").join(sets.selectExpr("_set", *folded), "_set")
            inside = stage(inside, "open_lists")
            need = f"{need} and {apart(MORE, '_more')}"
            x, y = inside.where("_root <> _largest").alias("x"), inside.alias("y")
            once = "(y._root = y._largest or x._set < y._set)"
            found = x.join(y, F.expr(f"x._token = y._token and x._root <> y._root and {need} and {once}"))
        pairs = found.select(pair) if turn else found.select(pair).unionByName(small)
        pairs = pairs.distinct()
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        unstage(largest, *([grouped] if links is not None else []), *([inside] if turn == ROUNDS else []))
        new = _verified(pairs, bits, rows, words, "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = new if links is None else links.unionByName(new)

    whole, rows = rows, stage(rows.select("_key", "_n", "_set"), "set_of_row")
    unstage(whole, sets, lists, small)
    of_set = rows.where("_set is not null").groupBy("_set").agg(F.min("_key").alias("_first"))
    joined = of_set.join(components(links).withColumnRenamed("node", "_set"), "_set", "left")
    joined = stage(joined.select("_set", "_first", F.coalesce("root", "_set").alias("_root")), "grouped_sets")
    named_roots = stage(joined.groupBy("_root").agg(F.min("_first").alias("_component")), "component_names")
    of_set = stage(joined.join(named_roots, "_root").select("_set", "_component"), "component_of_set")
    return rows.join(of_set, "_set", "left").select(
        F.col("_key").cast(kind).alias(key),
        F.col("_n").alias("n_shingles"),
        F.when(F.col("_set").isNull(), F.col("_key")).otherwise(F.col("_component")).alias("component_id"),
    )
