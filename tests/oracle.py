"""Compare a query with its SQL on DuckDB: columns, row count and every value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tidemark.sources.tables import TABLE_NAMES


def open_tables(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "NaN" if math.isnan(number) else number
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    want = rows_of(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{mine} instead of {theirs} ({sorted(names)})"
    return None
