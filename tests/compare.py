"""Comparing a Spark result with the same query in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


_DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_differences(df, connection, sql: str) -> list[str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    duck = {row[0]: row[1] for row in described}
    return [
        f"{name}: {kind} / {duck.get(name)}"
        for name, kind in df.dtypes
        if _DUCK_TYPES.get(kind) != duck.get(name)
    ]


def spark_table(df):
    return _table(df.columns, [tuple(row) for row in df.collect()])


def duck_table(connection, sql: str):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return _table(columns, cursor.fetchall())
