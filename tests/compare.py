"""Run registered queries in Spark and their SQL in DuckDB and compare values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "\0"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, float):
        return f"f{v!r}"
    if isinstance(v, int):
        return f"i{v}"
    return f"s{v}"


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short description."""
    got_cols, got = _sorted(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = _sorted([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns differ: {got_cols} != {want_cols}"
    if got != want:
        g, w = set(got), set(want)
        return (
            f"rows {len(got)} vs {len(want)}; only spark {sorted(g - w)[:3]}; only sql {sorted(w - g)[:3]}"
        )
    if not got:
        return "no rows on either side"
    return None
