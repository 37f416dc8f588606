"""Compare query results with DuckDB over the same Parquet files."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def assert_same(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> None:
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    expected = _rows(names, answer.fetchall())
    assert {name: _TYPES[kind] for name, kind in df.dtypes} == {
        column[0]: str(column[1]) for column in answer.description
    }
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    assert len(actual) == len(expected)
    for ours, theirs in zip(actual, expected):
        assert ours == theirs
