"""Missing values per column and overall completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from plumbline.config import Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, selected, string_columns
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check


def null_rate_checks(df: DataFrame, limits: Thresholds) -> list[Check]:
    """Nulls plus, in string columns, empty strings; one check per column."""
    texts = string_columns(df)
    found = []
    for column in df.columns:
        limit = float(limits.max_null_rate.get(column, limits.default_max_null_rate))
        nulls, empties = sql.name(f"nulls of {column}"), "0L"
        metrics = {"rows": "count(*)", f"nulls of {column}": sql.count_true(f"{sql.name(column)} IS NULL")}
        if column in texts:
            empties = sql.name(f"empties of {column}")
            metrics[f"empties of {column}"] = sql.count_true(f"{sql.name(column)} = ''")
        observed = sql.rate(f"({nulls} + {empties})", "rows")
        found.append(
            Check(
                dimension="completeness",
                name=f"null_rate_{column}",
                column=column,
                metrics=metrics,
                fields={
                    "column": sql.string(column),
                    "total_rows": "rows",
                    "null_count": nulls,
                    "empty_string_count": empties,
                    "total_missing": f"{nulls} + {empties}",
                    "null_rate": observed,
                },
                passed=f"{observed} <= {sql.double(limit)}",
                score=sql.penalty(observed, limit),
                threshold=limit,
                basis=observed,
                present="rows > 0",
            )
        )
    return found


def null_rates(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Missing rate of every column against its threshold; one scan for all columns."""
    df = nan_to_null(df)
    return fused.flat(df, null_rate_checks(df, limits))


def overall(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """1 minus the mean missing rate over all columns."""
    df = nan_to_null(df)
    return fused.overall(fused.check_rows(df, null_rate_checks(df, limits)), "completeness", limits)


def _null_percentages(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """(column, percentage of nulls); empty strings are values here."""
    df = nan_to_null(selected(df, columns))
    counts = {f"nulls of {c}": sql.count_true(f"{sql.name(c)} IS NULL") for c in columns}
    row = fused.aggregated(df, {"rows": "count(*)", **counts})
    return row.selectExpr(
        sql.inline(
            [
                sql.struct({"column": sql.string(c), name: f"{sql.rate(sql.name(f'nulls of {c}'), 'rows')} * 100"})
                for c in columns
            ]
        )
    )


def null_rate_comparison(dirty: DataFrame, clean: DataFrame) -> DataFrame:
    """Null percentages of the shared columns side by side, where the first table has any nulls.

    Both sides shrink to one row per column before they meet.
    """
    shared = [c for c in dirty.columns if c in clean.columns]
    pairs = _null_percentages(dirty, shared, "dirty_null_pct").join(
        _null_percentages(clean, shared, "clean_null_pct"), "column"
    )
    return pairs.filter("dirty_null_pct > 0")


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null percentage of the selected columns."""
    return _null_percentages(df, [c for c in columns if c in df.columns], "missing_pct")
