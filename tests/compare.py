"""Compare query results of Spark and DuckDB as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    """Values of different types are different: 1, 1.0 and true do not match."""
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else f"{type(value).__name__} {value}"


def difference(spark_rows, spark_columns, duck_rows, duck_columns) -> str | None:
    """A description of the first difference, None if both hold the same rows."""
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns {sorted(spark_columns)} != {sorted(duck_columns)}"
    order = sorted(spark_columns)
    left = Counter(tuple(_cell(r[spark_columns.index(c)]) for c in order) for r in spark_rows)
    right = Counter(tuple(_cell(r[duck_columns.index(c)]) for c in order) for r in duck_rows)
    if left == right:
        return None
    only_left, only_right = list((left - right).elements()), list((right - left).elements())
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows, {order}\n"
        f"  only Spark  ({len(only_left)}): {sorted(only_left, key=str)[:4]}\n"
        f"  only DuckDB ({len(only_right)}): {sorted(only_right, key=str)[:4]}"
    )
