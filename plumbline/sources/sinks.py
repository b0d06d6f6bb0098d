"""Report tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_checks(checks: DataFrame, path: str, run_id: str) -> None:
    """Store the checks of a run in its own folder; writing the same run again replaces it."""
    checks.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def write_report(report: DataFrame, path: str, file_format: str = "json") -> None:
    """Append report rows, partitioned by the day of the run."""
    report.withColumn("run_date", F.to_date("ts")).write.mode("append").partitionBy("run_date").format(file_format).save(path)


def latest_report(reports: DataFrame) -> DataFrame:
    """The most recent report row: each task keeps one row."""
    newest = reports.agg(F.max_by(F.struct(*reports.columns), "ts").alias("report"))
    return newest.filter(F.col("report").isNotNull()).select("report.*")
