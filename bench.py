"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of Parquet tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (optional, comma
separated) the queries. Each query runs twice in one session; the second, warm run counts. Building the frame is part
of the time, since fitting operators scan the table there.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import queries  # noqa: E402

HEADLINE = (
    "completeness_null_rate", "uniqueness_exact", "uniqueness_key", "validity_format", "validity_range",
    "consistency_referential", "consistency_mapping", "timeliness_freshness", "accuracy_distribution", "quality_checks",
    "anomaly_iqr", "anomaly_zscore", "anomaly_mad", "outlier_samples", "drift_events", "isolation_forest",
    "anomaly_checks", "overall_score", "merged_report", "profile_base", "profile_numeric", "profile_top_values",
    "profile_entropy", "table_profile", "quality_timeline", "category_share", "histogram", "history_trend",
    "alert_rules", "windowed_metrics", "isolation_top", "catalog", "profile_samples", "kpis", "outlier_rows", "frequent_values",
    "checks_while_writing", "sketch_quantiles",
)


def session(cores: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = session(cores)
    registered = queries()
    seconds: dict[str, float] = {}
    for name in chosen:
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cores) if cores.isdigit() else cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
