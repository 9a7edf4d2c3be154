"""Counters and Bloom filters over hashes of all rows, of a size that does not grow without bound.

Each task sends what its rows make in slices, which are merged by slice; no task holds the tables of all tasks.
The merged table goes to the executors, and the shuffle files behind it go at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from spanloom.llm.rows import nullable, slices
from spanloom.sources.stage import stage, unstage

SLICE = 1 << 19  # bits of a slice of a filter
MOST_BITS = 1 << 28  # 32 MB, the largest filter that is sent to the executors
PROBES = 4
CELLS = 1 << 15  # counters that travel together

Hashes = Callable[[], Callable[[pa.RecordBatch], np.ndarray]]  # builds, in a task, a function from rows to hashes


def slices_for(items: int) -> int:
    """Slices of a filter with eight bits an item, up to ``MOST_BITS``."""
    return max(1, min(MOST_BITS, 1 << max(0, 8 * items - 1).bit_length()) // SLICE)


def _codes(hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Slice of each hash, and the 32 bits that name it inside the slice."""
    own = (hashes >> np.uint64(40)) % np.uint64(count)
    return own.astype(np.int64), hashes.astype(np.uint32)


def _bits(codes: np.ndarray) -> np.ndarray:
    """The ``PROBES`` bits of each code inside its slice."""
    step = (codes >> np.uint32(13)) | np.uint32(1)
    return (codes[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint32)) % np.uint32(SLICE)


def _filled(codes: np.ndarray) -> np.ndarray:
    plane = np.zeros(SLICE, bool)
    plane[_bits(codes).ravel()] = True
    return np.packbits(plane)


def _packed(codes: np.ndarray) -> bytes:
    """Codes of a slice, or its bits where those are smaller."""
    return codes.tobytes() if codes.nbytes < SLICE // 8 else _filled(codes).tobytes()


def _plane(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).copy() if len(packed) == SLICE // 8 else _filled(np.frombuffer(packed, np.uint32))


def bloom(df: DataFrame, hashes: Hashes, count: int, twice: bool) -> np.ndarray:
    """Bloom filter of ``count`` slices: of all hashes, or of those given twice or more.

    Two filters are kept, once seen and twice seen. Those of two tasks are merged as ``once | once`` and
    ``twice | twice | once & once``, which misses nothing.
    """
    schema = nullable("slice int, once binary, again binary")
    arrow = to_arrow_schema(schema)

    def local(batches):
        fn = hashes()
        found = [fn(part) for part in slices(batches)]
        if not found:
            return
        known, times = np.unique(np.concatenate(found), return_counts=True)
        own, codes = _codes(known, count)
        order = np.argsort(own, kind="stable")
        own, codes, more = own[order], codes[order], times[order] > 1
        for at in np.unique(own).tolist():
            start, stop = np.searchsorted(own, [at, at + 1])
            some = codes[start:stop]
            again = _packed(some[more[start:stop]]) if twice else b""
            yield pa.RecordBatch.from_pylist([{"slice": at, "once": _packed(some), "again": again}], arrow)

    def merge(batches):
        planes = {}
        for batch in batches:
            for row in batch.to_pylist():
                once, again = _plane(row["once"]), _plane(row["again"])
                if row["slice"] in planes:
                    seen, seen_again = planes[row["slice"]]
                    seen_again |= again | (seen & once)
                    seen |= once
                else:
                    planes[row["slice"]] = once, again
        for at, pair in planes.items():
            yield pa.RecordBatch.from_pylist([{"slice": at, "once": pair[twice].tobytes(), "again": None}], arrow)

    tasks = min(count, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    merged = df.mapInArrow(local, schema).repartition(tasks, "slice").mapInArrow(merge, schema)
    merged = stage(merged.select("slice", "once"), "filter_slices", drop_shuffles=True)
    whole = np.zeros((count, SLICE // 8), np.uint8)
    for row in merged.collect():  # MOST_BITS at most
        whole[row["slice"]] = np.frombuffer(row["once"], np.uint8)
    unstage(merged)
    return whole


def contains(planes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    own, codes = _codes(hashes, len(planes))
    bits = _bits(codes)
    return ((planes[own[:, None], bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1).all(axis=1)


def _counts(packed: bytes) -> np.ndarray:
    plain = zlib.decompress(packed)
    return np.frombuffer(plain, f"u{len(plain) // CELLS}")


def row_counts(df: DataFrame, hashes: Callable, cells: int) -> tuple[np.ndarray, int]:
    """In how many rows hashes fall on each of ``cells`` counters, and the number of rows. ``hashes`` builds
    a function from the value of a row's first column to its hashes."""
    schema = nullable("slice int, counts binary, n long")
    arrow = to_arrow_schema(schema)

    def send(rows, tables):
        yield pa.RecordBatch.from_pylist([{"slice": -1, "counts": b"", "n": rows}], arrow)
        for at, own in tables:
            if own.any():
                counts = zlib.compress(own.astype(np.min_scalar_type(int(own.max()))).tobytes(), 1)
                yield pa.RecordBatch.from_pylist([{"slice": at, "counts": counts, "n": 0}], arrow)

    def local(batches):
        fn, counts, rows = hashes(), np.zeros(cells, np.int32), 0
        for part in slices(batches):
            for value in part.column(0).to_pylist():
                rows += 1
                counts[(fn(value) % np.uint64(cells)).astype(np.int64)] += 1
        yield from send(rows, ((at, counts[at * CELLS : (at + 1) * CELLS]) for at in range(cells // CELLS)))

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        rows = 0
        for batch in batches:
            for row in batch.to_pylist():
                rows += row["n"]
                if row["slice"] >= 0:
                    own = sums.setdefault(row["slice"], np.zeros(CELLS, np.int64))
                    own += _counts(row["counts"]).astype(np.int64)
        yield from send(rows, sums.items())

    tasks = min(cells // CELLS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts, rows = np.zeros(cells, np.int64), 0
    merged = stage(df.mapInArrow(local, schema).repartition(tasks, "slice").mapInArrow(merge, schema), "row_counts", drop_shuffles=True)
    for row in merged.toLocalIterator():
        rows += row["n"]
        if row["slice"] >= 0:
            counts[row["slice"] * CELLS : (row["slice"] + 1) * CELLS] = _counts(row["counts"])
    unstage(merged)
    return counts, rows
