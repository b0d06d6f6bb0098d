"""A complete run: quality and anomaly checks stored, then report, alerts and history derived from the stored rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import Thresholds
from plumbline.operators import alerts, history, scoring
from plumbline.sources.sinks import write_checks


@dataclass(frozen=True)
class Audit:
    """Frames of one run, all derived from its stored check rows."""

    checks: DataFrame
    report: DataFrame
    alerts: DataFrame


def run(
    spark: SparkSession,
    path: str,
    run_id: str,
    quality: DataFrame,
    anomaly: DataFrame | None = None,
    drift_events: DataFrame | None = None,
    rules: Mapping[str, bool] | None = None,
    limits: Thresholds = Thresholds(),
) -> Audit:
    """Store the checks under ``path``/checks and one history row under ``path``/history.

    The checks are evaluated once, when they are written; everything else reads the few stored rows. Storing a
    ``run_id`` again replaces its checks and its history row.
    """
    merged = quality.withColumn("origin", F.lit("quality"))
    if anomaly is not None:
        merged = merged.unionByName(anomaly.withColumn("origin", F.lit("anomaly")))
    write_checks(merged, f"{path}/checks", run_id)
    stored = spark.read.schema(merged.schema).parquet(f"{path}/checks/run_id={run_id}")
    report = scoring.report(stored, limits)
    if anomaly is not None:
        both = scoring.merged_report(
            stored.filter("origin = 'quality'").drop("origin"), stored.filter("origin = 'anomaly'").drop("origin"), limits
        )
        taken = ("overall_score", "status", "dimension_scores")
        report = report.withColumn("_merged", both.select(F.struct(*taken).alias("s")).scalar())
        report = report.withColumns({c: F.col(f"_merged.{c}") for c in taken}).drop("_merged")
    history.append(report, f"{path}/history", "full" if anomaly is not None else "validate_only", run_id)
    return Audit(stored, report, alerts.alerts(report, drift_events, rules, limits))
