"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark and DuckDB names of one type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def assert_same(df, connection, sql: str) -> int:
    result = connection.sql(sql)
    expected_types = dict(zip(result.columns, map(str, result.types), strict=True))
    actual_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    assert actual_types == expected_types
    expected = _rows(result.columns, result.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    assert len(actual) == len(expected)
    different = [(a, b) for a, b in zip(actual, expected, strict=True) if a != b]
    assert not different, different[:5]
    return len(actual)
