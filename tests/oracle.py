"""Run a query and its SQL side by side and compare rows regardless of order."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Number of rows; raises on any difference."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    expected = normal(names, result.fetchall())
    actual = normal(df.columns, df.collect())
    assert len(actual) == len(expected), (len(actual), len(expected))
    for got, want in zip(actual, expected, strict=True):
        assert got == want, (sorted(names), got, want)
    spark_kinds = dict(df.dtypes)
    for name, kind in kinds.items():
        assert _kin(spark_kinds[name]) == _kin(kind), (name, spark_kinds[name], kind)
    return len(actual)


def _kin(kind: str) -> str:
    """One name per type, whichever engine reports it."""
    same = {"integer": "int", "varchar": "string", "bool": "boolean"}
    return same.get(kind.lower(), kind.lower())
