"""Formats, dates and value ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.config import RATE_PASS, RATE_ZERO_SCORE, Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import as_timestamp, has, nan_to_null
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check


def _matches(column: str, pattern: str) -> str:
    return f"CAST({sql.name(column)} AS STRING) RLIKE {sql.string(pattern)}"


def format_checks(df: DataFrame, limits: Thresholds, roles: Roles) -> list[Check]:
    """Share of non-null values that match a pattern; an empty string is a value and does not match."""
    found = []
    for column, (name, pattern) in roles.formats.items():
        if not has(df, column):
            continue
        checked, valid = sql.name(f"values of {column}"), sql.name(f"well formed in {column}")
        observed = sql.rate(valid, checked)
        found.append(
            Check(
                dimension="validity",
                name=name,
                column=column,
                metrics={
                    f"values of {column}": f"count({sql.name(column)})",
                    f"well formed in {column}": sql.count_true(_matches(column, pattern)),
                },
                fields={
                    "column": sql.string(column),
                    "values_checked": checked,
                    "valid": valid,
                    "invalid": f"{checked} - {valid}",
                    "validity_rate": observed,
                },
                passed=f"{observed} >= {sql.double(limits.min_format_rate)}",
                score=sql.attainment(observed, limits.min_format_rate),
                threshold=limits.min_format_rate,
                present=f"{checked} > 0",
            )
        )
    return found


def future_date_checks(df: DataFrame, limits: Thresholds, roles: Roles, as_of=None, clamp: bool = False) -> list[Check]:
    """Dates after ``as_of`` as a share of all rows. The score falls below zero unless ``clamp`` is set."""
    column = roles.event_time
    if not has(df, column):
        return []
    parsed = sql.name(f"time of {column}")
    limit = float(limits.max_future_rate)
    future, failures = sql.name(f"future in {column}"), sql.name(f"unparsed in {column}")
    observed = sql.rate(future, "rows")
    score = f"1D - {observed} / {sql.double(limit)}" if limit > 0 else "1D"
    return [
        Check(
            dimension="validity",
            name="future_dates",
            column=column,
            inputs={f"time of {column}": as_timestamp(df, column, roles.time_formats)},
            metrics={
                "rows": "count(*)",
                f"future in {column}": sql.count_true(f"{parsed} > {sql.timestamp(as_of)}"),
                f"unparsed in {column}": sql.count_true(f"{parsed} IS NULL"),
            },
            fields={
                "column": sql.string(column),
                "total_rows": "rows",
                "future_dates": future,
                "future_date_rate": observed,
                "parse_failures": failures,
                "parse_success_rate": f"1D - {sql.rate(failures, 'rows')}",
            },
            passed=f"{observed} <= {sql.double(limit)}",
            score=f"greatest(0D, {score})" if clamp else score,
            threshold=limit,
            present="rows > 0",
        )
    ]


def range_checks(df: DataFrame, limits: Thresholds) -> list[Check]:
    """Non-null values outside inclusive bounds; a missing bound is open."""
    found = []
    for column, (low, high) in limits.ranges.items():
        if not has(df, column):
            continue
        value = sql.as_double(column)
        checked, outside = sql.name(f"values of {column}"), sql.name(f"out of range in {column}")
        beyond = [f"{value} < {sql.double(low)}"] if low is not None else []
        beyond += [f"{value} > {sql.double(high)}"] if high is not None else []
        observed = sql.rate(outside, checked)
        found.append(
            Check(
                dimension="validity",
                name=f"range_check_{column}",
                column=column,
                metrics={
                    f"values of {column}": f"count({sql.name(column)})",
                    f"out of range in {column}": sql.count_true(" OR ".join(beyond) or "false"),
                    f"least {column}": f"min({value})",
                    f"greatest {column}": f"max({value})",
                },
                fields={
                    "column": sql.string(column),
                    "range_min": sql.double(low),
                    "range_max": sql.double(high),
                    "values_checked": checked,
                    "out_of_range": outside,
                    "out_of_range_rate": observed,
                    "actual_min": sql.name(f"least {column}"),
                    "actual_max": sql.name(f"greatest {column}"),
                },
                passed=f"{observed} <= {sql.double(RATE_PASS)}",
                score=sql.penalty(observed, RATE_ZERO_SCORE),
                threshold=RATE_PASS,
                present=f"{checked} > 0",
            )
        )
    return found


def validity_checks(df: DataFrame, limits: Thresholds, roles: Roles, as_of=None, clamp: bool = False) -> list[Check]:
    return [
        *format_checks(df, limits, roles),
        *future_date_checks(df, limits, roles, as_of, clamp),
        *range_checks(df, limits),
    ]


def formats(df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles()) -> DataFrame:
    return fused.flat(df, format_checks(df, limits, roles))


def invalid_samples(df: DataFrame, column: str, pattern: str, k: int = 5) -> DataFrame:
    """The k smallest values that do not match: each task keeps k, so nothing is sorted as a whole."""
    wrong = df.filter(f"{sql.name(column)} IS NOT NULL AND NOT {_matches(column, pattern)}")
    return wrong.selectExpr(f"{sql.name(column)} AS value").orderBy("value").limit(k)


def future_dates(
    df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles(), as_of=None, clamp: bool = False
) -> DataFrame:
    flat = fused.flat(df, future_date_checks(df, limits, roles, as_of, clamp))
    return flat.drop("parse_failures", "parse_success_rate")


def parse_rate(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """How many values of the event time cannot be parsed; nulls count as failures."""
    flat = fused.flat(df, future_date_checks(df, Thresholds(), roles))
    return flat.select("column", "total_rows", "parse_failures", "parse_success_rate")


def ranges(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    df = nan_to_null(df)
    return fused.flat(df, range_checks(df, limits))


def overall(df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles(), as_of=None) -> DataFrame:
    df = nan_to_null(df)
    rows = fused.check_rows(df, validity_checks(df, limits, roles, as_of))
    return fused.overall(rows, "validity", limits)
