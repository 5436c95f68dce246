"""Runs a registered query and its SQL equivalent and compares the row bags."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, folder: str, db, build, sql: str) -> str | None:
    """None when both agree, else a description of the difference."""
    df = build(spark, folder)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(sql)
    columns = [d[0] for d in found.description]
    want = _bag(columns, found.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows vs {sum(want.values())};"
            f" extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
        )
    return None if got else "both sides are empty"
