"""Compare a Spark result with its SQL counterpart: names, row count, every value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return float(value)
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _normal(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    return _normal([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, otherwise a short description."""
    ours, theirs = spark_rows(df), oracle_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {sorted(set(ours[0]) ^ set(theirs[0]))}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} vs {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            where = [c for c, x, y in zip(ours[0], a, b) if x != y]
            total = sum(x != y for x, y in zip(ours[1], theirs[1]))
            return f"{total} rows differ, first in {where}: {a} vs {b}"
    return None
