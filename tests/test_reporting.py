"""Scores, reports, history, alerts and stored runs."""

from __future__ import annotations

import pytest

from plumbline.config import Thresholds, alert_rules
from plumbline.operators import alerts, history, scoring
from plumbline.plans import audit
from plumbline.sources import sinks


def checks(spark, rows):
    df = spark.createDataFrame(rows, "dimension string, check string, passed boolean, score double")
    return scoring.finished(
        df.selectExpr("*", "CAST(NULL AS STRING) AS column", "0D AS threshold", "'{}' AS details"), "set", "2026-02-01 00:00:00"
    )


@pytest.fixture(scope="module")
def sample(spark):
    return checks(
        spark,
        [
            ("completeness", "a", True, 0.7),
            ("completeness", "b", True, 0.84),
            ("completeness", "overall_completeness", True, 0.1),
            ("uniqueness", "c", False, 0.46),
            ("validity", "d", True, 0.82),
            ("timeliness", "overall_timeliness", True, 1.0),
        ],
    )


WEIGHTS = {"completeness": 5.0, "uniqueness": 1.0, "validity": 2.0, "timeliness": 0.0}


def test_dimension_and_overall_scores(sample):
    scores = {r["dimension"]: r["score"] for r in scoring.dimension_scores(sample).collect()}
    assert scores == {"completeness": pytest.approx(0.77), "uniqueness": 0.46, "validity": 0.82, "timeliness": 0.0}
    row = scoring.overall_score(scoring.dimension_scores(sample), weights=WEIGHTS).first()
    assert row["overall_score"] == pytest.approx((5 * 0.77 + 0.46 + 2 * 0.82) / 8)
    assert row["status"] == "warning"


def test_unlisted_dimensions_weigh_the_default(spark):
    scores = spark.sql("SELECT * FROM VALUES ('completeness', 1D), ('other', 0D) AS t(dimension, score)")
    assert scoring.overall_score(scores).first()["overall_score"] == pytest.approx(0.25 / 0.45)
    assert scoring.overall_score(scores, weights={}).first()["overall_score"] == pytest.approx(0.5)


def test_no_checks_is_unknown(sample):
    row = scoring.report(sample.limit(0)).first()
    assert (row["overall_score"], row["status"], row["num_checks"]) == (0.0, "unknown", 0)


@pytest.mark.parametrize(("score", "status"), [(0.49, "critical"), (0.5, "warning"), (0.7499, "warning"), (0.75, "pass")])
def test_status_limits(spark, score, status):
    assert scoring.report(checks(spark, [("x", "y", True, score)])).first()["status"] == status


def test_report_totals(sample):
    row = scoring.report(sample, weights=WEIGHTS).first()
    assert (row["num_checks"], row["num_passed"], row["num_failed"]) == (6, 5, 1)
    assert row["dimension_scores"] == {"completeness": 0.77, "timeliness": 0.0, "uniqueness": 0.46, "validity": 0.82}
    assert row["dataset"] == "set" and str(row["ts"]) == "2026-02-01 00:00:00"


def test_labels(sample):
    found = {r["dimension"]: r["status"] for r in scoring.dimension_status(sample).collect()}
    assert found == {"completeness": "PASS", "uniqueness": "FAIL", "validity": "PASS", "timeliness": "FAIL"}


def test_merged_report_prefers_the_anomaly_score(spark, sample):
    anomaly = checks(spark, [("anomaly_iqr", "i", True, 0.5), ("uniqueness", "u", False, 0.9)])
    row = scoring.merged_report(sample, anomaly).first()
    assert row["overall_score"] == round((0.77 + 0.9 + 0.82 + 0.0 + 0.5) / 5, 4)
    assert (row["num_checks"], row["num_failed"]) == (8, 2)
    merged = scoring.merged_dimension_scores(scoring.dimension_scores(sample), scoring.dimension_scores(anomaly))
    assert {r["dimension"]: r["score"] for r in merged.collect()}["uniqueness"] == 0.9


def scores(spark, values):
    rows = ", ".join(f"(TIMESTAMP '2026-01-{i:02d} 00:00:00', {v}D)" for i, v in enumerate(values, 1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(ts, overall_score)")


@pytest.mark.parametrize(
    ("values", "trend"),
    [([0.5, 0.5, 0.6, 0.6], "improving"), ([0.6, 0.5], "degrading"), ([0.5, 0.51, 0.52], "stable"), ([0.9], "stable")],
)
def test_trend(spark, values, trend):
    row = history.trend(scores(spark, values)).first()
    assert row["trend"] == trend and row["count"] == len(values)
    assert row["current"] == round(values[-1] * 100, 1) and row["max"] == round(max(values) * 100, 1)


def test_trend_of_nothing(spark):
    row = history.trend(scores(spark, [0.5]).limit(0)).first()
    assert (row["trend"], row["count"], row["current"], row["avg"]) == ("unknown", 0, None, None)


def test_recent_keeps_the_newest_or_the_oldest(spark):
    df = scores(spark, [i / 100 for i in range(1, 29)])
    newest = [r["ts"].day for r in history.recent(df, "2026-02-01", days=20, limit=3).collect()]
    oldest = [r["ts"].day for r in history.recent(df, "2026-02-01", days=20, limit=3, oldest=True).collect()]
    assert newest == [26, 27, 28] and oldest == [12, 13, 14]
    assert history.latest(df).first()["ts"].day == 28


def test_alert_rules(spark, sample):
    report = scoring.report(sample)
    events = spark.sql("SELECT * FROM VALUES ('m'), ('m'), ('k') AS t(metric)")
    fired = alerts.alerts(report, events, {"any_failures": True}, Thresholds(critical=0.9)).collect()
    assert sorted((r["type"], r["metric"], r["event_count"]) for r in fired if r["metric"]) == [("drift_events", "k", 1), ("drift_events", "m", 2)]
    assert {r["type"]: r["event_count"] for r in fired if not r["metric"]} == {"critical_score": None, "any_failures": 1}


def test_daily_summary_only_when_quiet(spark, sample):
    report = scoring.report(sample)
    quiet = alerts.alerts(report, None, limits=Thresholds(critical=0.0)).collect()
    assert [r["type"] for r in quiet] == ["daily_summary"]
    assert alerts.alerts(report, None, {"daily_summary": False}, Thresholds(critical=0.0)).count() == 0
    nothing_else = {"critical_score": False, "drift_events": False}
    assert alerts.alerts(report, None, nothing_else).count() == 1
    assert alerts.alerts(report, None, {**nothing_else, "daily_summary": False}).count() == 0


def test_rule_switches():
    assert alert_rules() == {"critical_score": True, "any_failures": False, "drift_events": True, "daily_summary": True}
    with pytest.raises(ValueError, match="unknown alert rules"):
        alert_rules({"weekly": True})


def test_thresholds_from_sections(tmp_path):
    limits = Thresholds.from_mapping(
        {
            "completeness": {"max_null_rate": {"a": 0.3, "_default": 0.2}},
            "validity": {"range_checks": {"q": {"min": 1}}},
            "scoring": {"severity": {"critical": 0.1}},
        }
    )
    assert limits.max_null_rate == {"a": 0.3} and limits.default_max_null_rate == 0.2
    assert limits.ranges == {"q": (1, None)} and limits.critical == 0.1 and limits.max_age_hours == 48
    assert Thresholds.load(str(tmp_path / "absent.json")) == Thresholds()
    (tmp_path / "t.json").write_text('{"timeliness": {"max_data_freshness_hours": 8760}}')
    assert Thresholds.load(str(tmp_path / "t.json")).max_age_hours == 8760


def test_stored_runs_and_history(spark, sample, tmp_path):
    path = str(tmp_path)
    anomaly = checks(spark, [("anomaly_iqr", "i", True, 0.5)])
    first = audit.run(spark, path, "r1", sample, anomaly)
    assert first.checks.count() == 7
    assert first.report.first()["overall_score"] == round((0.77 + 0.46 + 0.82 + 0.0 + 0.5) / 5, 4)
    assert {r["type"] for r in first.alerts.collect()} == {"daily_summary"}
    audit.run(spark, path, "r1", sample)
    stored = spark.read.parquet(f"{path}/checks")
    assert stored.count() == 6, "the same run again replaces its checks"
    kept = history.read(spark, f"{path}/history")
    assert [r["run_type"] for r in kept.collect()] == ["validate_only"], "and its history row"
    second = audit.run(spark, path, "r2", sample, checks(spark, [("uniqueness", "x", True, 0.9)])).report.first()
    assert history.recent(history.read(spark, f"{path}/history"), "2026-02-02").count() == 2
    assert second["dimension_scores"]["uniqueness"] == 0.9, "scores are those of the merged report"


def test_report_sink(spark, sample, tmp_path):
    path = str(tmp_path / "reports")
    sinks.write_report(scoring.report(sample), path, "parquet")
    sinks.write_report(scoring.report(sample).selectExpr("* EXCEPT (ts, dataset)", "ts + INTERVAL 1 DAY AS ts", "'later' AS dataset"), path, "parquet")
    reports = spark.read.parquet(path)
    assert reports.count() == 2 and sinks.latest_report(reports).first()["dataset"] == "later"
    assert sinks.latest_report(reports.limit(0)).count() == 0
