"""Order-insensitive comparison of a Spark result with its SQL counterpart."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# DuckDB names of Spark types.
TYPE_NAMES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values must be equal, not just close."""
    expected = connection.execute(sql)
    columns = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    expected_rows = expected.fetchall()
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    wrong = []
    for name, kind in result.dtypes:
        wanted = TYPE_NAMES.get(kind, kind.upper())
        if wanted.replace(",", "").replace(" ", "") != kinds[name].replace(",", "").replace(" ", ""):
            wrong.append(f"{name}: {kind} != {kinds[name]}")
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(columns, expected_rows)
    if got != want:
        extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} vs {sum(want.values())} rows; only in Spark {extra}; only in SQL {lacking}; types {wrong}"
    return f"types {wrong}" if wrong else None
