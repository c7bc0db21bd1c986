"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame


SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def _canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: [(v is None, str(type(v)), v) for v in row])


def spark_types(df: DataFrame) -> dict[str, str]:
    return {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return _canonical(df.columns, [tuple(row) for row in df.collect()])


def _query(sql: str, sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    return connection.execute(sql)


def duckdb_types(sql: str, sf_dir: str) -> dict[str, str]:
    return {column[0]: str(column[1]) for column in _query(sql, sf_dir).description}


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    result = _query(sql, sf_dir)
    return _canonical([column[0] for column in result.description], result.fetchall())
