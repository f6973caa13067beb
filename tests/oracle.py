"""Runs a registered query and its SQL on the same files and compares all rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return None if math.isnan(value) else ("float", f"{value:.12g}")
    if isinstance(value, int):
        return value
    if isinstance(value, datetime | date):
        return value.isoformat()
    return str(value)


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, db, query, sql, sf_dir) -> tuple[int, str | None]:
    """Row count and, if different, a short description."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    want = rows(names, result.fetchall())
    n = sum(got.values())
    if sorted(df.columns) != sorted(names):
        return n, f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return n, (
            f"{n} rows, expected {sum(want.values())}; extra {sum((got - want).values())}"
            f" e.g. {extra}; missing {sum((want - got).values())} e.g. {missing}"
        )
    return n, None
