"""Compare registered queries with their SQL on another engine."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(folder, t)}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    ours = _rows(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        extra = [r for r in ours if r not in set(theirs)][:3] if len(ours) < 50000 else ""
        missing = [r for r in theirs if r not in set(ours)][:3] if len(ours) < 50000 else ""
        return f"rows {len(ours)} != {len(theirs)}; only ours {extra}; only theirs {missing}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ, first: {bad[0]}"
    return None
