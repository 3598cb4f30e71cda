"""Comparison of a Spark result with a DuckDB result, columns by name, rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

from loomwork.catalog.registry import TABLES


def duck(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return (type(value).__name__, value.isoformat())
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def rows_of_duck(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())
    return [columns[i] for i in order], rows


def duck_types(connection, sql):
    return {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
