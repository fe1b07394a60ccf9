"""Compares registered queries with their SQL on DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def assert_same(table, connection, sql: str) -> int:
    """Equal column names, types and multisets of rows; returns the row count."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = Counter(result.fetchall())
    assert sorted(names) == sorted(table.columns)
    assert {name: TYPES[kind] for name, kind in table.dtypes} == types
    found = Counter(tuple(row) for row in table.select(*names).collect())
    assert found == expected
    return sum(expected.values())
