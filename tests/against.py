"""Comparison of a query with its SQL, ignoring row order."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _key(row):
    return tuple((value is not None, str(type(value)), value if value is not None else 0) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    columns = sorted(frame.columns)
    return columns, sorted((tuple(_plain(v) for v in row) for row in frame.select(*[f"`{c}`" for c in columns]).collect()), key=_key)


def rows_of_sql(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(_plain(row[i]) for i in order) for row in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def compare(spark, connection, folder: str, name: str, query, sql: str | None) -> tuple[str, float, int]:
    start = time.time()
    columns, rows = rows_of(query(spark, folder))
    spent = time.time() - start
    if sql is None:
        return "rows only", spent, len(rows)
    expected_columns, expected = rows_of_sql(connection, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}", spent, len(rows)
    if len(rows) != len(expected):
        return f"{len(rows)} rows, expected {len(expected)}", spent, len(rows)
    for row, other in zip(rows, expected):
        if row != other or [type(v) for v in row] != [type(v) for v in other]:
            return f"{dict(zip(columns, zip(row, other)))}", spent, len(rows)
    return "ok", spent, len(rows)
