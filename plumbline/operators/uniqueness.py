"""Duplicate rows and duplicate keys.

Both count rows beyond the first of each group: sum(copies - 1). Copies are summed on the map side first, so a row or
key that makes up a third of the table reaches the shuffle once per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import has, nan_to_null
from plumbline.functions.digest import row_digest, row_width
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check

# Rows up to this many bytes are grouped as they are; wider ones by their 32-byte digest.
NARROW_ROW_BYTES = 64


def _copies(df: DataFrame, columns: Sequence[str], method: str) -> DataFrame:
    if method == "values":
        groups = df.groupBy(*[sql.name(c) for c in columns])
    elif method == "digest":
        groups = df.groupBy(F.expr(row_digest(df, columns)).alias("_digest"))
    else:
        raise ValueError(f"unknown method {method!r}; use 'values' or 'digest'")
    return groups.agg(F.expr("count(*) AS copies")).select("copies")


def row_copies(df: DataFrame, method: str = "auto") -> DataFrame:
    """Number of copies of each distinct row (nulls equal), as one column ``copies``.

    ``method``: "values" groups by all columns, "digest" by a SHA-256 of them, so that the shuffle carries 32 bytes per
    distinct row instead of the row; "auto" takes the smaller.
    """
    if method == "auto":
        width = row_width(df)
        method = "values" if width is not None and width <= NARROW_ROW_BYTES else "digest"
    return _copies(df, df.columns, method)


def key_copies(df: DataFrame, keys: Sequence[str], method: str = "values") -> DataFrame:
    """Number of rows per key value; null is a value like any other. "digest" suits long texts as keys."""
    return _copies(df, keys, method)


def _check(name: str, column: str | None, fields: dict[str, str], limits: Thresholds) -> Check:
    limit = float(limits.max_duplicate_rate)
    observed = sql.rate("repeated", "rows")
    return Check(
        dimension="uniqueness",
        name=name,
        column=column,
        metrics={"rows": "sum(copies)", "repeated": "sum(copies - 1)"},
        fields={**fields, "duplicate_rate": observed},
        passed=f"{observed} <= {sql.double(limit)}",
        score=sql.penalty(observed, limit),
        threshold=limit,
        basis=f"round({observed}, 4)",
        present="rows > 0",
    )


def exact_check(limits: Thresholds) -> Check:
    return _check("exact_row_duplicates", None, {"total_rows": "rows", "duplicate_rows": "repeated"}, limits)


def key_check(keys: Sequence[str], limits: Thresholds) -> Check:
    key = ",".join(keys)
    fields = {"key_column": sql.string(key), "total_rows": "rows", "duplicate_keys": "repeated"}
    return _check("key_duplicates_" + "_".join(keys), key, fields, limits)


def present_keys(df: DataFrame, roles: Roles) -> list[tuple[str, ...]]:
    """Configured keys (a name, or a tuple of names for a composite key) whose columns all exist."""
    keys = [(k,) if isinstance(k, str) else tuple(k) for k in roles.keys]
    return [k for k in keys if has(df, *k)]


def exact_duplicates(df: DataFrame, limits: Thresholds = Thresholds(), method: str = "auto") -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    return fused.flat(row_copies(nan_to_null(df), method), [exact_check(limits)])


def key_duplicates(
    df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles(), method: str = "values"
) -> DataFrame:
    """Rows that repeat an earlier row's key, one result per configured key."""
    df = nan_to_null(df)
    parts = [fused.flat(key_copies(df, k, method), [key_check(k, limits)]) for k in present_keys(df, roles)]
    if not parts:
        raise ValueError(f"none of the key columns {roles.keys} exist in this table")
    return reduce(DataFrame.unionByName, parts)


def check_rows(df: DataFrame, limits: Thresholds, roles: Roles) -> DataFrame:
    parts = [fused.check_rows(row_copies(df), [exact_check(limits)])]
    parts += [fused.check_rows(key_copies(df, k), [key_check(k, limits)]) for k in present_keys(df, roles)]
    return reduce(DataFrame.unionByName, parts)


def overall(df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles()) -> DataFrame:
    """1 minus twice the mean of the duplicate rates (each rounded to four places)."""
    return fused.overall(check_rows(nan_to_null(df), limits, roles), "uniqueness", limits)
