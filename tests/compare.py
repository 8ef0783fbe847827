"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        v = float(v)
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def differences(df, con, sql) -> list[str]:
    """Empty when both results hold the same columns and rows."""
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _rows([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        a, b = set(got), set(want)
        out.append(f"columns {got_cols}")
        out += [f"spark only {r}" for r in sorted(a - b, key=repr)[:3]]
        out += [f"sql only   {r}" for r in sorted(b - a, key=repr)[:3]]
        out.append(f"{len(a - b)} / {len(b - a)} differ")
    return out
