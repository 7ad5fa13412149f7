"""Rows of a Spark frame and of DuckDB's answer to SQL, in one comparable form."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(names), sorted(out, key=repr)


def of_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def of_duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    con.execute("set timezone = 'UTC'")
    r = con.execute(sql)
    return rows([d[0] for d in r.description], r.fetchall())


def difference(df, sf_dir: str, sql: str) -> str | None:
    """What differs, in words; None if nothing does."""
    (a, x), (b, y) = of_spark(df), of_duck(sf_dir, sql)
    if a != b:
        return f"columns {a} and {b}"
    if len(x) != len(y):
        return f"{len(x)} and {len(y)} rows"
    for i, (r, s) in enumerate(zip(x, y, strict=True)):
        if r != s and not all(p == q or isinstance(p, (int, float)) and isinstance(q, (int, float)) and math.isclose(p, q, rel_tol=1e-9, abs_tol=2e-6) for p, q in zip(r, s, strict=True)):
            return f"row {i} of {len(x)}: {r} and {s}"
    return None
