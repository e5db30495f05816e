"""Runs a registered query and its SQL twin and compares all values."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, Decimal)):
        return round(float(value), 6)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return str(value)


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, make, sql: str, sf_dir: str) -> tuple[int, list[str], list, list]:
    """Number of rows, column mismatch, rows only in Spark, rows only in SQL."""
    frame = make(spark, sf_dir)
    ours = _rows(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    return (
        sum(ours.values()),
        sorted(set(names) ^ set(frame.columns)),
        list((ours - theirs).items())[:3],
        list((theirs - ours).items())[:3],
    )
