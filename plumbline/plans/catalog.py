"""A catalog over several tables and the comparison of two."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from plumbline.functions import sqltext as sql
from plumbline.operators.profile import base_profile, table_profile


def _present(tables: Mapping[str, DataFrame | None]) -> dict[str, DataFrame]:
    found = {name: df for name, df in tables.items() if df is not None}
    if not found:
        raise ValueError("a catalog needs at least one table")
    return found


def catalog(tables: Mapping[str, DataFrame | None], mode: str = "exact") -> DataFrame:
    """One profile row per table; tables given as None are left out."""
    return reduce(DataFrame.unionByName, [table_profile(df, name, mode) for name, df in _present(tables).items()])


def catalog_columns(tables: Mapping[str, DataFrame | None], mode: str = "exact") -> DataFrame:
    """One profile row per column of every table."""
    parts = [
        base_profile(df, mode).selectExpr(f"{sql.string(name)} AS table_name", "*") for name, df in _present(tables).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cross_table(left: DataFrame, right: DataFrame) -> DataFrame:
    """Shared and one-sided columns, row difference and its percentage of the right table; one row.

    Column sets are known from the schemas; only the two counts touch data.
    """
    a, b = set(left.columns), set(right.columns)
    counted = left.selectExpr("count(*) AS left_rows").withColumn("right_rows", right.selectExpr("count(*)").scalar())
    return counted.selectExpr(
        f"{sql.string(','.join(sorted(a & b)))} AS shared_columns",
        f"{sql.string(','.join(sorted(a - b)))} AS left_only",
        f"{sql.string(','.join(sorted(b - a)))} AS right_only",
        "left_rows",
        "right_rows",
        "left_rows - right_rows AS row_count_diff",
        "CASE WHEN right_rows > 0 THEN round((left_rows - right_rows) / right_rows * 100, 2) ELSE 0D END "
        "AS row_count_diff_pct",
    )
