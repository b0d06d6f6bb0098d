"""Score history: an append-only table of report rows, its recent part and its trend."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql

TREND_STEP = 0.02

HISTORY_SCHEMA = (
    "ts timestamp, overall_score double, status string, dimension_scores map<string,double>, num_checks bigint, "
    "num_passed bigint, num_failed bigint, run_type string, run_date date"
)


def append(report: DataFrame, path: str, run_type: str = "full", run_id: str | None = None) -> None:
    """Add report rows to the history at ``path``, in a folder per run and day; the same run again replaces its rows."""
    rows = report.selectExpr(
        "ts",
        "overall_score",
        "status",
        "dimension_scores",
        "num_checks",
        "num_passed",
        "num_failed",
        f"{sql.string(run_type)} AS run_type",
        "to_date(ts) AS run_date",
    )
    folder = f"{path}/run_id={uuid.uuid4().hex if run_id is None else run_id}"
    rows.write.mode("overwrite").partitionBy("run_date").parquet(folder)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).parquet(path).drop("run_id")


def recent(history: DataFrame, as_of=None, days: int = 30, limit: int | None = None, oldest: bool = False) -> DataFrame:
    """Snapshots of the last ``days``, in order of time; with a ``limit`` the newest (or oldest) ones.

    The day partition is filtered too where there is one, so older files are not read.
    """
    since = f"{sql.timestamp(as_of)} - INTERVAL {int(days)} DAYS"
    kept = history.filter(f"ts >= {since}")
    if "run_date" in history.columns:
        kept = kept.filter(f"run_date >= to_date({since})")
    if limit is not None:
        kept = kept.orderBy(F.asc("ts") if oldest else F.desc("ts")).limit(limit)
    return kept.orderBy("ts")


def latest(history: DataFrame) -> DataFrame:
    """The newest snapshot, or no row."""
    return history.orderBy(F.desc("ts")).limit(1)


def trend(history: DataFrame) -> DataFrame:
    """Current, least, greatest and mean score in percent, and whether the later half is better than the earlier.

    ``history`` is a bounded selection, as ``recent`` gives it; its scores are put in order inside one array.
    """
    ordered = history.selectExpr(
        "transform(array_sort(collect_list(struct(ts, overall_score))), r -> r.overall_score) AS scores"
    )
    mean = "aggregate({0}, 0D, (total, s) -> total + s) / size({0})"
    halves = ordered.selectExpr(
        "scores",
        "slice(scores, 1, size(scores) DIV 2) AS earlier",
        "slice(scores, size(scores) DIV 2 + 1, size(scores)) AS later",
    )
    summary = halves.selectExpr(
        "try_element_at(scores, -1) AS current",
        "array_min(scores) AS min",
        "array_max(scores) AS max",
        f"CASE WHEN size(scores) > 0 THEN {mean.format('scores')} END AS avg",
        "CAST(size(scores) AS BIGINT) AS count",
        f"CASE WHEN size(scores) > 1 THEN {mean.format('later')} - {mean.format('earlier')} END AS change",
    )
    return summary.selectExpr(
        *[f"round({c} * 100, 1) AS {c}" for c in ("current", "min", "max", "avg")],
        f"CASE WHEN count = 0 THEN 'unknown' WHEN change > {sql.double(TREND_STEP)} THEN 'improving' "
        f"WHEN change < -{sql.double(TREND_STEP)} THEN 'degrading' ELSE 'stable' END AS trend",
        "count",
    )


def series(history: DataFrame) -> DataFrame:
    """Date and score in percent, for plotting."""
    return history.selectExpr("to_date(ts) AS date", "overall_score * 100 AS score_pct")
