"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import duckdb

from tidemerge.queries import ORACLES, QUERIES
from tidemerge.queries.base import INPUT_TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in INPUT_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when both sides agree, else a short description of the difference."""
    df = QUERIES[name](spark, folder)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = _canonical(got_cols, got), _canonical(want_cols, want)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"rows {len(a)} vs {len(b)}; only spark {only_a}; only sql {only_b}"
