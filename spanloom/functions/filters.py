"""Bloom filters of integer keys, made and asked by SQL expressions alone.

A filter is a table of slices, each an array of 1024 words of 64 bits. A key belongs to one slice and one word of
it, and sets four bits of that word. Tasks combine the bits of their keys by word before anything is shuffled, and
slices are merged on their own. The filter goes to the executors, so its size is bounded; with more keys than it
is made for there is none, and callers go on without.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1024
BITS_A_KEY = 12
MOST_SLICES = 1 << 12  # 32 MB

_WORD = f"cast(pmod(shiftright(_bloom_hash, 12), {WORDS}) as int)"
_MASK = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(_bloom_hash, {at}) & 63 as int))" for at in (24, 32, 40, 48))


def slices_for(keys: int) -> int:
    """Slices of a filter for so many keys; 0 if they are too many for one."""
    wanted = max(1, -(-BITS_A_KEY * keys // (64 * WORDS)))
    return wanted if wanted <= MOST_SLICES else 0


def bloom_filter(keys: DataFrame, columns: list[str], slices: int) -> DataFrame:
    """``_bloom_slice, _bloom_words`` of the keys in ``columns``."""
    hashed = keys.select(F.xxhash64(*columns).alias("_bloom_hash"))
    bits = hashed.selectExpr(f"pmod(_bloom_hash, {slices}) as _bloom_slice", f"{_WORD} as _word", f"{_MASK} as _mask")
    # A row for every word, so that its place in the array is its number.
    every = keys.sparkSession.range(slices).selectExpr(
        "id as _bloom_slice", f"explode(sequence(0, {WORDS - 1})) as _word", "0L as _mask"
    )
    words = bits.unionByName(every).groupBy("_bloom_slice", "_word").agg(F.expr("bit_or(_mask) as _bits"))
    return words.groupBy("_bloom_slice").agg(
        F.expr("transform(sort_array(collect_list(struct(_word, _bits))), x -> x._bits) as _bloom_words")
    )


def may_hold(rows: DataFrame, columns: list[str], made: DataFrame, slices: int) -> DataFrame:
    """Those of ``rows`` whose key may be in the filter: all that are, and few others."""
    hashed = rows.select("*", F.xxhash64(*columns).alias("_bloom_hash")).selectExpr("*", f"pmod(_bloom_hash, {slices}) as _bloom_slice")
    asked = hashed.join(F.broadcast(made), "_bloom_slice")  # MOST_SLICES at most
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return asked.where(f"(_bloom_words[{_WORD}] & ({_MASK})) = ({_MASK})").select(*kept)


def semi_join(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Exact semi join of many rows with a table of keys: rows that a filter of the keys rules out do not move.

    ``keys`` is read twice, so it should be a table. Beyond the greatest filter all rows move, as in any join.
    """
    slices = slices_for(keys.count())
    left = may_hold(rows, columns, bloom_filter(keys, columns, slices), slices) if slices else rows
    return left.join(keys.select(*columns), columns, "left_semi")
