"""Run a query in Spark and its check in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal

import duckdb

from duesmith.sources.billing_views import with_views

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:.6f}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return rows_of(columns, result.fetchall())


def duck_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}


def check(connection, query, bundle):
    assert query.check is not None
    spark_columns, actual = spark_rows(query.run(bundle))
    duck_columns, expected = duck_rows(connection, with_views(query.check))
    return spark_columns, duck_columns, actual, expected
