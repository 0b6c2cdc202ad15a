"""Compare registered queries with their SQL counterparts: names, row counts and values."""

from __future__ import annotations

import math
import pathlib

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = pathlib.Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """A description of the first difference, or None."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = _rows(names, answer.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    for ours, theirs in zip(found, expected):
        if ours != theirs:
            return f"{ours}\nagainst\n{theirs}"[:3000]
    return None
