"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def differences(spark_df, connection, sql):
    """Empty if equal, otherwise a short account of what differs."""
    cursor = connection.execute(sql)
    expected_names = [c[0] for c in cursor.description]
    expected = _sorted(cursor.fetchall(), expected_names)
    if sorted(spark_df.columns) != sorted(expected_names):
        return [f"columns {sorted(spark_df.columns)} instead of {sorted(expected_names)}"]
    found = _sorted([tuple(row) for row in spark_df.collect()], spark_df.columns)
    if len(found) != len(expected):
        return [f"{len(found)} rows instead of {len(expected)}"] + [
            f"only one side: {row}" for row in list(set(found) ^ set(expected))[:4]
        ]
    return [f"{a} instead of {b}" for a, b in zip(found, expected) if a != b][:4]
