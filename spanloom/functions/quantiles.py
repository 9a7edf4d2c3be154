"""Exact grouped statistics without a per-group buffer.

The built-in exact percentiles keep every distinct value of a group in one task's memory. A hot
statement or wait event can own a large part of all rows, so here the work is split by value:

1. count rows per (key, value bucket) - partial aggregation leaves few rows to shuffle,
2. find the bucket of each wanted rank from the running counts of a key's buckets, which are
   bounded in number by the bucketing (see ``buckets``),
3. go back to the rows of just those buckets and rank the distinct values inside.

No group ever meets in one place unless it is one bucket of one key, already reduced to distinct
values. The join of step 3 is left to adaptive execution: broadcast if the targets are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.buckets import bucket_low

_BITS = 10
# SQL: 1-based ranks of the two middle values and of the discrete 99th percentile of _n values.
_RANKS = {"_low": "((_n + 1) div 2)", "_high": "(_n div 2 + 1)", "_p99": "(_n - _n div 100)"}


def grouped_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: ``n`` rows, ``total``, ``median``, ``p99`` and ``max`` of an integer column.

    ``median`` interpolates between the two middle values; ``p99`` is the smallest value with at
    least 99 % of the values at or below it. NULL values count in ``n`` only; NULL is a key.
    """
    rows = df.selectExpr(*keys, f"cast({value} as bigint) as _v").selectExpr(
        "*", f"{bucket_low('_v', _BITS)} as _b"
    )
    histogram = rows.groupBy(*keys, "_b").agg(
        F.expr("count(*) as _rows"), F.expr("sum(_v) as _sum"), F.expr("max(_v) as _max")
    )
    names = [f"_k{i}" for i in range(len(keys))]
    of_key = f"partition by {', '.join(keys)}"
    valued = "if(_b is null, 0L, _rows)"
    ranked = histogram.selectExpr(
        *[f"{k} as {n}" for k, n in zip(keys, names)],
        "_b as _target",
        f"{valued} as _here",
        f"sum({valued}) over ({of_key} order by _b rows between unbounded preceding and current row) as _upto",
        f"sum({valued}) over ({of_key}) as _n",
        f"sum(_rows) over ({of_key}) as n",
        f"sum(_sum) over ({of_key}) as total",
        f"max(_max) over ({of_key}) as max",
    )
    holds = " or ".join(f"(_upto - _here < {r} and {r} <= _upto)" for r in _RANKS.values())
    targets = ranked.where(f"{holds} or (_n = 0 and _target is null)").selectExpr(
        *names, "_target", "_upto - _here as _before", "_n", "n", "total", "max"
    )

    same = " and ".join(["_b <=> _target", *[f"{k} <=> {n}" for k, n in zip(keys, names)]])
    carried = ("_before", "_n", "n", "total", "max")
    # Grouped by value, not by bucket: so the join's partitioning does not serve the grouping, rows are
    # combined before a shuffle of their own, and adaptive execution may split a hot bucket's join.
    distinct = (
        rows.join(targets, F.expr(same))
        .groupBy(*keys, "_v")
        .agg(F.expr("count(*) as _here"), *[F.expr(f"max({c}) as {c}") for c in ("_b", *carried)])
    )
    in_bucket = f"partition by {', '.join(keys)}, _b order by _v"
    placed = distinct.selectExpr(
        "*",
        f"_before + sum(_here) over ({in_bucket} rows between unbounded preceding and current row) as _upto",
    )
    out = placed.groupBy(*keys).agg(
        *[F.expr(f"max({c}) as {c}") for c in ("n", "total", "max")],
        *[
            F.expr(f"max(if(_upto - _here < {r} and {r} <= _upto, _v, null)) as {name}")
            for name, r in _RANKS.items()
        ],
    )
    return out.selectExpr(
        *keys, "n", "total", "cast(_low + _high as double) / 2D as median", "_p99 as p99", "max"
    )
