"""Compare a Spark result with its SQL form in DuckDB: names, row count and values, any row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    have_cols, have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if have_cols != want_cols:
        return f"columns {have_cols} != {want_cols}"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}"
    for a, b in zip(have, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a!r} != {b!r}"
    return None
