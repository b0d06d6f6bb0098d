"""Numeric distributions compared with a trusted copy of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import ACCURACY_MAX_SHIFT, EPSILON, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, numeric_columns, selected
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check


def distribution_checks(df: DataFrame, truth: DataFrame) -> list[Check]:
    """Relative shift of the mean per shared numeric column.

    The trusted side is one aggregated row, read as a scalar subquery: no join, and both sides are scanned once.
    """
    truth_numeric = set(numeric_columns(truth))
    shared = [c for c in numeric_columns(df) if c in truth_numeric]
    if not shared:
        return []
    cells = {"rows": "count(*)"}
    for column in shared:
        value = sql.as_double(column)
        cells |= {f"mean {column}": f"avg({value})", f"std {column}": f"stddev_samp({value})"}
    truth_row = nan_to_null(selected(truth, shared)).agg(F.expr(sql.struct(cells)).alias("truth")).scalar()
    found = []
    for column in shared:
        value = sql.as_double(column)
        mean, spread, values = (sql.name(f"{p} of {column}") for p in ("mean", "std", "values"))
        true_mean, true_spread = (f"truth.{sql.name(f'{p} {column}')}" for p in ("mean", "std"))
        shift = f"(abs({mean} - {true_mean}) / (abs({true_mean}) + {sql.double(EPSILON)}))"
        found.append(
            Check(
                dimension="accuracy",
                name=f"distribution_comparison_{column}",
                column=column,
                metrics={
                    f"mean of {column}": f"avg({value})",
                    f"std of {column}": f"stddev_samp({value})",
                    f"values of {column}": f"count({sql.name(column)})",
                },
                derived={"truth": truth_row},
                fields={
                    "column": sql.string(column),
                    "dirty_mean": mean,
                    "clean_mean": true_mean,
                    "mean_shift": shift,
                    "dirty_std": spread,
                    "clean_std": true_spread,
                    "dirty_count": values,
                    "clean_count": "truth.rows",
                },
                passed=f"{shift} <= {sql.double(ACCURACY_MAX_SHIFT)}",
                score=f"greatest(0D, 1D - {shift} * 5)",
                threshold=ACCURACY_MAX_SHIFT,
                present=f"{values} > 0 AND truth.rows > 0",
            )
        )
    return found


def distributions(df: DataFrame, truth: DataFrame) -> DataFrame:
    df = nan_to_null(df)
    return fused.flat(df, distribution_checks(df, truth))


def overall(df: DataFrame, truth: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    df = nan_to_null(df)
    return fused.overall(fused.check_rows(df, distribution_checks(df, truth)), "accuracy", limits)
