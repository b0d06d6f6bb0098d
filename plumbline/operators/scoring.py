"""From check rows to dimension scores, an overall score and a status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULT_WEIGHT, Thresholds
from plumbline.functions import sqltext as sql

CHECK_SCHEMA = (
    "dataset string, dimension string, check string, column string, passed boolean, score double, threshold double, "
    "details string, ts timestamp"
)

# The mean behind a dimension score leaves the dimension's own overall check out.
_SINGLE = "CASE WHEN NOT startswith(check, 'overall_') THEN score END"


def finished(rows: DataFrame, dataset: str, as_of=None) -> DataFrame:
    """Check rows in ``CHECK_SCHEMA``: named and dated."""
    return rows.selectExpr(
        f"{sql.string(dataset)} AS dataset",
        "dimension",
        "check",
        "column",
        "passed",
        "score",
        "threshold",
        "details",
        f"{sql.timestamp(as_of)} AS ts",
    )


def _weight(weights: Mapping[str, float]) -> str:
    """Weight of a dimension; the mapping has a few entries and becomes a literal."""
    if not weights:
        return sql.double(DEFAULT_WEIGHT)
    cells = ", ".join(f"{sql.string(name)}, {sql.double(value)}" for name, value in weights.items())
    return f"coalesce(try_element_at(map({cells}), dimension), {sql.double(DEFAULT_WEIGHT)})"


def status_of(score: str, limits: Thresholds) -> str:
    return (
        f"CASE WHEN {score} < {sql.double(limits.critical)} THEN 'critical' "
        f"WHEN {score} < {sql.double(limits.warning)} THEN 'warning' ELSE 'pass' END"
    )


def _overall_status(limits: Thresholds) -> str:
    return f"CASE WHEN dimensions = 0 THEN 'unknown' ELSE {status_of('overall_score', limits)} END AS status"


def dimension_scores(checks: DataFrame, skip_empty: bool = False) -> DataFrame:
    """Mean score per dimension without its ``overall_*`` check.

    A dimension that has nothing but an overall check scores 0, or is left out with ``skip_empty``.
    """
    scores = checks.groupBy("dimension").agg(F.expr(f"avg({_SINGLE}) AS score"))
    if skip_empty:
        return scores.filter("score IS NOT NULL")
    return scores.selectExpr("dimension", "coalesce(score, 0D) AS score")


def dimension_status(checks: DataFrame) -> DataFrame:
    label = "CASE WHEN score >= 0.75D THEN 'PASS' WHEN score >= 0.50D THEN 'WARN' ELSE 'FAIL' END AS status"
    return dimension_scores(checks).selectExpr("*", label).orderBy("dimension")


def _weighted(weights: Mapping[str, float]) -> str:
    weight = _weight(weights)
    return f"coalesce(try_divide(sum(score * {weight}), sum({weight})), 0D) AS overall_score"


def overall_score(scores: DataFrame, limits: Thresholds = Thresholds(), weights: Mapping | None = None) -> DataFrame:
    """Weighted mean over the dimensions that are present, and its status; no dimensions give 0 and 'unknown'."""
    total = scores.selectExpr("count(*) AS dimensions", _weighted(limits.weights if weights is None else weights))
    return total.selectExpr("*", _overall_status(limits))


def report(checks: DataFrame, limits: Thresholds = Thresholds(), weights: Mapping | None = None) -> DataFrame:
    """One row: overall score, status, dimension scores, check counts (scores rounded to four places).

    Dimensions are aggregated with their check counts, so the checks are evaluated once.
    """
    per_dimension = checks.groupBy("dimension").agg(
        F.expr(f"coalesce(avg({_SINGLE}), 0D) AS score"),
        F.expr("count(*) AS checks"),
        F.expr("count_if(passed) AS passed"),
        F.expr("max(ts) AS ts"),
        F.expr("max(dataset) AS dataset"),
    )
    total = per_dimension.selectExpr(
        "max(dataset) AS dataset",
        "max(ts) AS ts",
        "count(*) AS dimensions",
        _weighted(limits.weights if weights is None else weights),
        "map_from_entries(array_sort(collect_list(struct(dimension, round(score, 4))))) AS dimension_scores",
        "coalesce(sum(checks), 0L) AS num_checks",
        "coalesce(sum(passed), 0L) AS num_passed",
    )
    return total.selectExpr(
        "dataset",
        "ts",
        "round(overall_score, 4) AS overall_score",
        _overall_status(limits),
        "dimension_scores",
        "num_checks",
        "num_passed",
        "num_checks - num_passed AS num_failed",
    )


def merged_dimension_scores(quality: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Union of two sets of dimension scores; where both have one, the anomaly score wins."""
    ranked = quality.selectExpr("dimension", "score", "0 AS _origin").unionByName(
        anomaly.selectExpr("dimension", "score", "1 AS _origin")
    )
    return ranked.groupBy("dimension").agg(F.expr("max_by(score, _origin) AS score"))


def merged_report(quality: DataFrame, anomaly: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """One report over both sets of checks; the overall score is the plain mean of the dimension scores.

    Built from one pass over the union of the checks: scores are averaged per (dimension, origin) and the anomaly
    origin takes precedence.
    """
    union = quality.selectExpr("*", "0 AS _origin").unionByName(anomaly.selectExpr("*", "1 AS _origin"))
    parts = union.groupBy("dimension", "_origin").agg(
        F.expr(f"coalesce(avg({_SINGLE}), 0D) AS score"),
        F.expr("count(*) AS checks"),
        F.expr("count_if(passed) AS passed"),
    )
    dimensions = parts.groupBy("dimension").agg(
        F.expr("max_by(score, _origin) AS score"), F.expr("sum(checks) AS checks"), F.expr("sum(passed) AS passed")
    )
    total = dimensions.selectExpr(
        "coalesce(avg(score), 0D) AS overall_score",
        "count(*) AS dimensions",
        "map_from_entries(array_sort(collect_list(struct(dimension, round(score, 4))))) AS dimension_scores",
        "coalesce(sum(checks), 0L) AS num_checks",
        "coalesce(sum(passed), 0L) AS num_passed",
    )
    return total.selectExpr(
        "dimensions",
        "round(overall_score, 4) AS overall_score",
        _overall_status(limits),
        "dimension_scores",
        "num_checks",
        "num_passed",
        "num_checks - num_passed AS num_failed",
    )


def check_totals(checks: DataFrame) -> DataFrame:
    return checks.groupBy("passed").agg(F.expr("count(*) AS checks"))


def failures_by_dimension(checks: DataFrame) -> DataFrame:
    return checks.filter("NOT passed").groupBy("dimension").agg(F.expr("count(*) AS failures"))
