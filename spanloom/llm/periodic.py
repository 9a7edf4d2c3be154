"""Periodic runs of words: stretches that repeat a shorter passage four times and more.

A dictionary of basic factors gives every factor of L = 1, 2, 4, ... words a name, equal for equal factors of one
text: names of factors of 2 L words are made from the pairs of names of their halves. Occurrences of a factor are
listed in order; a position whose next occurrence is d <= 2 L words away proposes the period d.

Let a run have the smallest period q and at least 4 q words, and L be the power of two with q <= L < 2 q. Inside
of the run the next occurrence of a factor of L words is always exactly q away: one at d < q would give its stretch
the periods d and q, hence (Fine and Wilf) their common divisor, a period smaller than q of the whole run. So
all positions of the run but the last q + L - 1 propose q: the run's occurrences are arithmetic progressions
of difference q, side by side. Positions side by side that propose the same d make one stretch of period d; it is extended
word by word at both ends. Of proposals for the same stretch the smallest period stays, which is the stretch's
smallest one, since that is proposed too.

A factor that occurs once in its text is no part of any longer factor that occurs twice, so its positions leave the
dictionary at once; ordinary text is gone after a few levels. Texts share arrays, so short ones cost little.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spanloom.llm.rows import nullable, slices

TOGETHER = 1 << 17  # words whose texts share arrays
_RUN = "array<struct<start: long, length: long, period: long>>"


def runs_of(codes: np.ndarray, bounds: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, stop, period)`` of the runs of several texts, ascending. ``codes`` are the words of all texts as
    small numbers, ``bounds`` the place where each text starts, and the end."""
    total = len(codes)
    lengths = np.diff(bounds)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    stops = np.repeat(bounds[1:], lengths)
    names = owner * np.int64(codes.max(initial=0) + 1) + codes  # of one text
    where = np.arange(total)
    found = []
    size = 1
    while len(where):
        order = np.argsort(names[where], kind="stable")  # by name, then place
        listed, place = names[where[order]], where[order]
        same = listed[1:] == listed[:-1]
        gaps = np.zeros(total, np.int64)
        gaps[place[:-1][same]] = (place[1:] - place[:-1])[same]
        near = np.flatnonzero((gaps > 0) & (gaps <= 2 * size))
        if len(near):
            cut = np.flatnonzero((np.diff(near) != 1) | (np.diff(gaps[near]) != 0)) + 1
            first, last = near[np.concatenate([[0], cut])], near[np.concatenate([cut - 1, [len(near) - 1]])]
            period = gaps[first]
            stop = last + size + period
            kept = stop - first >= np.maximum(least, times * period)
            found.append(_extended(codes, bounds, owner, first[kept], stop[kept], period[kept]))
        # Names of factors twice as long, from halves that both occur more than once.
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        fresh = np.full(total, -1, np.int64)
        fresh[place[again]] = np.cumsum(np.concatenate([[True], ~same]))[again]
        where = np.flatnonzero(fresh >= 0)
        where = where[where + 2 * size <= stops[where]]
        where = where[fresh[where + size] >= 0]
        names = np.full(total, -1, np.int64)
        names[where] = fresh[where] * np.int64(len(order) + 1) + fresh[where + size]
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, stop, period = (np.concatenate(parts) for parts in zip(*found, strict=True))
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _extended(codes, bounds, owner, start, stop, period):
    """Stretches made as long as their periods hold, inside of their texts."""
    low, high = bounds[owner[start]], bounds[owner[start] + 1]
    start, stop = start.copy(), stop.copy()
    open_ = np.arange(len(start))
    while len(open_):
        open_ = open_[start[open_] > low[open_]]
        open_ = open_[codes[start[open_] - 1] == codes[start[open_] - 1 + period[open_]]]
        start[open_] -= 1
    open_ = np.arange(len(start))
    while len(open_):
        open_ = open_[stop[open_] < high[open_]]
        open_ = open_[codes[stop[open_]] == codes[stop[open_] - period[open_]]]
        stop[open_] += 1
    return start, stop, period


def periodic_runs(docs: DataFrame, times: int = 4, least: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``runs`` (array of ``start, length, period``, by start, then period) and ``collapsed``.

    Words are runs of other than ASCII white space, numbered from 0. A run is a stretch of words with smallest
    period q and at least ``least`` and ``times`` (4 or more) times q words which no neighbouring word
    extends. Runs of different periods may overlap. ``collapsed`` holds the words, joined by one space, that
    no run contains after its first q ones: each repeated passage stays once. A null, empty or blank text has
    no runs and an empty ``collapsed``. Rows are independent, so repeated rows give the same; an empty table
    gives no rows; other columns are not read. A text is worked on whole, in memory that grows with its length.
    """
    if times < 4:
        raise ValueError("runs of fewer than four times their period are not all proposed")
    field = T.StructField(key, docs.schema[key].dataType, True)
    schema = T.StructType([field, *nullable(f"runs {_RUN}, collapsed string").fields])
    arrow = to_arrow_schema(schema)

    def solve(texts: list[list[bytes]]) -> tuple[pa.Array, pa.Array]:
        ids: dict[bytes, int] = {}
        flat = [w for words in texts for w in words]
        codes = np.fromiter(map(ids.setdefault, flat, count()), np.int64, len(flat))
        bounds = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
        start, stop, period = runs_of(codes, bounds, times, least)
        at = np.searchsorted(start, bounds)  # runs of each text
        repeated = np.zeros(len(flat) + 1, np.int64)
        np.add.at(repeated, start + period, 1)
        np.add.at(repeated, stop, -1)
        stays = np.cumsum(repeated)[:-1] == 0
        kept = []
        for i, words in enumerate(texts):
            if at[i] < at[i + 1]:
                words = [words[j] for j in np.flatnonzero(stays[bounds[i] : bounds[i + 1]]).tolist()]
            kept.append(b" ".join(words))
        own = bounds[np.searchsorted(bounds, start, side="right") - 1] if len(start) else start
        items = pa.StructArray.from_arrays([pa.array(start - own), pa.array(stop - start), pa.array(period)], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), items)
        return lists.cast(arrow[1].type), pa.array(kept, pa.binary()).cast(pa.string())

    def some(batches):
        for part in slices(batches):
            texts: list[list[bytes]] = []
            held = done = 0
            for i, value in enumerate(part.column(1).to_pylist()):
                texts.append((value or "").encode().split())
                held += len(texts[-1])
                if held >= TOGETHER or i + 1 == part.num_rows:
                    names = part.column(0).slice(done, len(texts)).cast(arrow[0].type)
                    yield pa.RecordBatch.from_arrays([names, *solve(texts)], schema=arrow)
                    texts, held, done = [], 0, i + 1

    return docs.select(F.col(key), F.col(text)).mapInArrow(some, schema)
