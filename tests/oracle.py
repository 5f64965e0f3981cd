"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, Decimal):
        return f"{value:.6f}"
    if isinstance(value, int):
        return f"{value:.6f}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value) if value % 1 else f"{value:.6f}"
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Empty text if both agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return ""
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"rows {len(got)} / {len(want)}; only spark {only_got[:2]}; only sql {only_want[:2]}"
