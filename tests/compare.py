"""A Spark result against DuckDB SQL of the same meaning."""

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with a view of every table of ``folder``."""
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def assert_same(df, con, sql):
    """All rows and columns equal; without SQL, any rows at all."""
    got = rows_of(df.columns, df.collect())
    if sql is None:
        assert got
        return
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())
