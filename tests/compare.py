"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, None if they are equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    want, got = _rows(result.fetchall(), names), _rows(df.collect(), df.columns)
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            return f"columns {sorted(names)}: got {g} want {w}"
    return None
