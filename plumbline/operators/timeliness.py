"""Freshness and recency of the event time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.config import RECENT_DAYS, RECENT_MIN_RATIO, Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import as_timestamp, has
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check


def freshness_checks(df: DataFrame, limits: Thresholds, roles: Roles, as_of=None) -> list[Check]:
    """Hours between ``as_of`` and the newest parseable time; a time in the future counts as fresh."""
    column = roles.event_time
    if not has(df, column):
        return []
    parsed = sql.name(f"time of {column}")
    latest, dated = sql.name(f"latest {column}"), sql.name(f"dated {column}")
    hours = f"((unix_micros({sql.timestamp(as_of)}) - unix_micros({latest})) / 3600e6D)"
    limit = float(limits.max_age_hours)
    return [
        Check(
            dimension="timeliness",
            name="data_freshness",
            column=column,
            inputs={f"time of {column}": as_timestamp(df, column, roles.time_formats)},
            metrics={f"latest {column}": f"max({parsed})", f"dated {column}": f"count({parsed})"},
            fields={"column": sql.string(column), "most_recent_record": latest, "hours_since_update": hours},
            passed=f"{hours} <= {sql.double(limit)}",
            score=f"greatest(0D, least(1D, 1D - {hours} / {sql.double(limit)}))",
            threshold=limit,
            present=f"{dated} > 0",
        )
    ]


def recency_checks(df: DataFrame, limits: Thresholds, roles: Roles, as_of=None) -> list[Check]:
    """Share of the parseable times that lie in the last days before ``as_of`` or after it."""
    column = roles.event_time
    if not has(df, column):
        return []
    parsed = sql.name(f"time of {column}")
    cutoff = f"{sql.timestamp(as_of)} - INTERVAL {RECENT_DAYS} DAYS"
    earliest, latest, dated, recent = (sql.name(f"{p} {column}") for p in ("earliest", "latest", "dated", "recent"))
    ratio = sql.rate(recent, dated)
    return [
        Check(
            dimension="timeliness",
            name="recent_data_ratio",
            column=column,
            inputs={f"time of {column}": as_timestamp(df, column, roles.time_formats)},
            metrics={
                f"dated {column}": f"count({parsed})",
                f"recent {column}": sql.count_true(f"{parsed} >= {cutoff}"),
                f"earliest {column}": f"min({parsed})",
                f"latest {column}": f"max({parsed})",
            },
            fields={
                "column": sql.string(column),
                "total_dates": dated,
                "recent_records": recent,
                "recent_ratio": ratio,
                "min_date": earliest,
                "max_date": latest,
            },
            passed=f"{ratio} >= {sql.double(RECENT_MIN_RATIO)}",
            score=sql.attainment(ratio, RECENT_MIN_RATIO),
            threshold=RECENT_MIN_RATIO,
            present=f"{dated} > 0",
        )
    ]


def timeliness_checks(df: DataFrame, limits: Thresholds, roles: Roles, as_of=None) -> list[Check]:
    return [*freshness_checks(df, limits, roles, as_of), *recency_checks(df, limits, roles, as_of)]


def freshness(df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles(), as_of=None) -> DataFrame:
    return fused.flat(df, freshness_checks(df, limits, roles, as_of))


def recency(df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles(), as_of=None) -> DataFrame:
    return fused.flat(df, recency_checks(df, limits, roles, as_of))


def overall(df: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles(), as_of=None) -> DataFrame:
    rows = fused.check_rows(df, timeliness_checks(df, limits, roles, as_of))
    return fused.overall(rows, "timeliness", limits)
