"""Ordered state over long sequences, computed in blocks.

A running value over a trace file is a window ordered by line. Partitioned by file alone, a window
puts a whole file, or a whole hot cursor, into one task. Here a sequence is cut into blocks of
consecutive lines: every block is scanned on its own, the last state of each block (one row) is
carried over the blocks before it, and the two are combined. Tasks hold one block; the only
window over a whole sequence runs over one small row per block.

Expressions are SQL texts: they are parsed once on the JVM, while every operator of a Python column
costs a call.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_LINES = 1 << 16


@dataclass(frozen=True)
class Mark:
    """Rows that set a running value: where ``when`` holds, the value becomes ``value``.

    Both are SQL texts. ``strict`` marks take effect after their own row, ``peers`` marks already on
    all rows of the same order value. With ``since``, the name of another mark, the value is that of the first
    such row after the latest row of the other mark, and NULL until there is one.
    """

    when: str
    value: str
    strict: bool = False
    peers: bool = False
    since: str | None = None

    @property
    def frame(self) -> str:
        if self.peers:
            return "range between unbounded preceding and current row"
        return f"rows between unbounded preceding and {'1 preceding' if self.strict else 'current row'}"


def block_of(order: str, size: int = BLOCK_LINES) -> str:
    """SQL: number of the block of consecutive lines."""
    return f"({order} div {size}L)"


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: str,
    marks: dict[str, Mark],
    base: DataFrame | None = None,
    size: int = BLOCK_LINES,
) -> DataFrame:
    """Add, per mark, the column ``struct(at, value)`` of the latest mark row so far, else NULL.

    ``order`` is a bigint, unique within ``keys`` unless all marks are strict or for peers.
    ``base`` is a cheaper DataFrame with the same rows to take the block states from (``df`` if not
    given).
    """
    cut = block_of(order, size)
    source = df if base is None else base
    latest = {n: m for n, m in marks.items() if m.since is None}
    firsts = {n: m for n, m in marks.items() if m.since is not None}
    rows = {n: f"named_struct('at', {order}, 'value', {m.value})" for n, m in marks.items()}
    states = {n: f"case when {m.when} then {rows[n]} end" for n, m in marks.items()}
    key_names = [f"_k{i}" for i in range(len(keys))]
    by_block = [*[F.expr(f"{k} as {n}") for k, n in zip(keys, key_names)], F.expr(f"{cut} as _carry_block")]
    blocks = source.groupBy(*by_block).agg(*[F.expr(f"max({states[n]}) as _own_{n}") for n in latest])
    for n, mark in firsts.items():
        heads = _first_after(source, by_block, key_names, order, marks[mark.since].when, mark.when, rows[n])
        blocks = blocks.join(heads.withColumnRenamed("_head", f"_own_{n}"), [*key_names, "_carry_block"], "left")

    of_key = f"partition by {', '.join(key_names)} order by _carry_block"
    before = f"over ({of_key} rows between unbounded preceding and 1 preceding)"
    for n, mark in firsts.items():
        # The block of the latest row of the other mark, and the least of the heads since then.
        blocks = blocks.selectExpr(
            "*", f"max(if(_own_{mark.since} is not null, _carry_block, null)) over ({of_key}) as _from_{n}"
        ).selectExpr(
            "*",
            f"if(_from_{n} is null, null, min(_own_{n}) over (partition by {', '.join(key_names)}, _from_{n}"
            f" order by _carry_block)) as _run_{n}",
        )
    carried = blocks.selectExpr(
        *key_names,
        "_carry_block",
        *[f"last(_own_{n}, true) {before} as _in_{n}" for n in latest],
        *[f"lag(_run_{n}) over ({of_key}) as _in_{n}" for n in firsts],
    ).where(f"coalesce({', '.join(f'_in_{n}.at' for n in latest)}) is not null")
    same = " and ".join(
        ["_block = _carry_block", *[f"{k} = {n}" for k, n in zip(keys, key_names)]]
    )
    joined = df.selectExpr("*", f"{cut} as _block").join(carried, F.expr(same), "left")

    in_block = f"partition by {', '.join(keys)}, _block order by {order}"
    here = {n: f"last({states[n]}, true) over ({in_block} {m.frame})" for n, m in latest.items()}
    if not firsts:
        return joined.selectExpr(*df.columns, *[f"coalesce({here[n]}, _in_{n}) as {n}" for n in latest])

    ahead = f"over ({in_block} rows between unbounded preceding and 1 preceding)"
    upto = f"over ({in_block} rows between unbounded preceding and current row)"
    seen = joined.selectExpr(
        "*",
        *[f"{here[n]} as _here_{n}" for n in latest],
        *[f"max(if({m.when}, {order}, null)) {ahead} as _before_{n}" for n, m in firsts.items()],
    )
    found = {}
    for n, m in firsts.items():
        since = f"_here_{m.since}.at"
        opens = f"{m.when} and coalesce({order} > {since}, true) and coalesce(_before_{n} <= {since}, _before_{n} is null)"
        found[n] = f"last(case when {opens} then {rows[n]} end, true) {upto} as _here_{n}"
    seen = seen.selectExpr("*", *found.values())
    filled = [f"coalesce(_here_{n}, _in_{n}) as {n}" for n in latest]
    for n, m in firsts.items():
        since = f"_here_{m.since}.at"
        filled.append(
            f"""case when {since} is not null then if(_here_{n}.at > {since}, _here_{n}, null)
            when _in_{m.since} is not null then coalesce(_in_{n}, _here_{n}) end as {n}"""
        )
    return seen.selectExpr(*df.columns, *filled)


def _first_after(source: DataFrame, by_block: list, key_names: list[str], order: str, since: str, when: str, row: str) -> DataFrame:
    """Per block, ``_head``: the first row with ``when`` after the block's last row with ``since``."""
    block = [*key_names, "_carry_block"]
    tops = source.where(since).groupBy(*by_block).agg(F.expr(f"max({order}) as _top"))
    rows = source.where(when).select(*by_block, F.expr(f"{order} as _order"), F.expr(f"{row} as _row"))
    after = rows.join(tops, block, "left").where("coalesce(_order > _top, true)")
    return after.groupBy(*block).agg(F.expr("min(_row) as _head"))
