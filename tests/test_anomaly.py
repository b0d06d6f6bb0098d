"""Outliers, drift and the isolation forest."""

from __future__ import annotations

import numpy as np
import pytest

from plumbline.config import Roles
from plumbline.operators import drift, forest, outliers
from plumbline.plans.anomaly import anomaly_checks


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


@pytest.fixture(scope="module")
def values(spark):
    rows = [(float(v), "t", 5) for v in (1, 2, 3, 4, 5, 6, 7, 8, 9, 1000)] + [(None, "t", 5)]
    return spark.createDataFrame(rows, "x double, label string, constant int")


def test_iqr(values):
    row = by(outliers.outliers(values, "iqr"), "column")
    assert set(row) == {"x"}, "a column without spread is skipped"
    row = row["x"]
    assert (row["q1"], row["q3"], row["iqr"]) == (3.25, 7.75, 4.5)
    assert (row["lower_bound"], row["upper_bound"]) == (-3.5, 14.5)
    assert (row["values_checked"], row["outlier_count"], row["passed"], row["score"]) == (10, 1, False, 0.0)


def test_iqr_bounds_are_strict(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 10, 10, 20, 20, 30, 35, 50)], "x double")
    row = by(outliers.outliers(df, "iqr"), "column")["x"]
    edge = row["upper_bound"]
    widened = df.unionByName(spark.createDataFrame([(edge,)], "x double"))
    found = outliers.outlier_rows(widened, outliers.fit(df, methods=("iqr",)), ["x"])
    assert not by(found, "x")[edge]["iqr_x"]


def test_zscores(values):
    x = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 1000.0])
    row = by(outliers.outliers(values, "zscore", z_limit=2.0), "column")["x"]
    assert row["max_abs_z"] == pytest.approx(abs((x - x.mean()) / x.std(ddof=1)).max())
    assert row["outlier_count"] == 1
    median = np.median(x)
    mad = np.median(abs(x - median))
    row = by(outliers.outliers(values, "modified_zscore"), "column")["x"]
    assert row["max_abs_z"] == pytest.approx((0.6745 * abs(x - median) / mad).max())
    assert row["outlier_count"] == 1


def test_too_few_values_and_text_are_skipped(spark):
    few = spark.sql("SELECT * FROM VALUES (1), (2), (90) AS t(x)")
    assert outliers.outliers(few, "iqr").count() == 0
    assert outliers.fit(spark.sql("SELECT 'a' AS x")) == []
    with pytest.raises(ValueError, match="unknown methods"):
        outliers.fit(few, methods=("mean",))


def test_samples_are_the_most_extreme(values):
    bounds = outliers.fit(values, methods=("iqr",))
    assert [(r["column"], r["value"], r["rank"]) for r in outliers.outlier_samples(values, bounds, 3).collect()] == [("x", 1000.0, 1)]


def test_median_impute(values):
    filled = outliers.median_impute(values, ["x"])
    assert filled.filter("x IS NULL").count() == 0
    assert filled.filter("x = 5.5").count() == 1


def test_drift_on_a_hand_made_series(spark):
    rows = [("m", d, v) for d, v in enumerate((10, 10, 10, 10, 10, 10, 20, 10), 1)]
    rows += [("short", d, 1.0 * d) for d in range(1, 6)]
    rows += [("gap", d, None if d == 3 else 1.0 * (d % 2)) for d in range(1, 9)]
    series = spark.createDataFrame([(m, d, None if v is None else float(v)) for m, d, v in rows], "metric string, snapshot bigint, value double")
    events = drift.drift_events(series).collect()
    # The last point has the spike in its frame (mean 12, deviation 4), so |z| = 0.5.
    assert [(e["metric"], e["snapshot"], e["rolling_mean"]) for e in events] == [("m", 7, 10.0)]
    assert events[0]["rolling_std"] == 1e-10 and events[0]["z_score"] == pytest.approx(10 / 1e-10)
    summary = by(drift.drift_summary(series), "metric")
    assert set(summary) == {"m", "gap"}, "fewer than window + 1 snapshots give no result"
    assert summary["m"]["drift_rate"] == pytest.approx(1 / 3) and summary["m"]["score"] == 0.0
    assert [a["snapshot"] for a in summary["m"]["alerts"]] == [7]
    assert summary["gap"]["drift_events"] == 0 and summary["gap"]["snapshots"] == 8


def test_drift_deviation_is_of_the_population(spark):
    series = spark.createDataFrame([("m", d, float(v)) for d, v in enumerate((1, 2, 3, 4, 5, 6.0), 1)], "metric string, snapshot bigint, value double")
    event = drift.drift_events(series, sigma=2.0).collect()[0]
    assert event["z_score"] == pytest.approx(3 / np.std([1, 2, 3, 4, 5]))


def test_timeline_keeps_every_nth_point(spark):
    series = spark.range(1, 31).selectExpr("'m' AS metric", "id AS snapshot", "1D AS value")
    assert sorted(r["snapshot"] for r in drift.drift_timeline(series).collect()) == list(range(1, 31, 3))
    assert drift.drift_timeline(series.limit(4)).count() == 4


def test_snapshot_metrics(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'a', NULL, 999, 10D), (1, 'a', 'm', NULL, 30D), (1, 'b', 'm', 1, NULL), (1, NULL, 'm', 1, NULL), "
        "(2, NULL, 'm', 1, NULL) AS t(day, product_category, customer_email, quantity, total_amount)"
    )
    found = by(drift.snapshot_metrics(df, Roles()), "snapshot")
    first = found[1]
    assert first["null_rate_customer_email"] == 0.25 and first["outlier_quantity_999"] == 0.25
    assert first["order_count"] == 4 and first["avg_order_value"] == 20.0
    share = np.array([2 / 3, 1 / 3])
    assert first["category_entropy"] == pytest.approx(-(share * np.log(share + 1e-10)).sum())
    assert found[2]["category_entropy"] is None and found[2]["avg_order_value"] is None


@pytest.fixture(scope="module")
def cloud(spark):
    random = np.random.default_rng(3)
    rows = [(i, float(a), float(b), None if i % 50 == 0 else float(c)) for i, (a, b, c) in enumerate(random.normal(0, 1, (3000, 3)))]
    rows += [(3000 + i, 40.0 + i, -40.0, 40.0) for i in range(5)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double").repartition(6)


FEATURES = ["a", "b", "c"]


def test_forest_finds_planted_rows(cloud):
    model = forest.fit(cloud, FEATURES, ["id"])
    scored = model.transform(cloud)
    top = forest.most_anomalous(scored, ["id"], 5).collect()
    assert {r["id"] for r in top} == set(range(3000, 3005))
    row = forest.summary(scored, model).first()
    assert row["rows_analyzed"] == 3005 and abs(row["anomaly_rate"] - 0.05) < 0.01 and row["passed"]
    assert -0.5 < row["min_score"] < row["mean_score"] < row["max_score"] < 0.5


def test_forest_does_not_depend_on_partitioning(cloud):
    options = {"features": FEATURES, "key": ["id"], "trees": 20}
    one, two = forest.fit(cloud.repartition(1), **options), forest.fit(cloud.repartition(9, "id"), **options)
    assert one.offset == two.offset
    assert one.nodes.sort_values(["tree", "node"]).reset_index(drop=True).equals(two.nodes.sort_values(["tree", "node"]).reset_index(drop=True))


def test_forest_sample_is_bounded_without_a_key(cloud):
    model = forest.fit(cloud, FEATURES, trees=10, sample_per_tree=64)
    assert model.nodes.groupby("tree").size().max() <= 2 * 64


def test_forest_on_small_or_narrow_tables(spark, cloud):
    assert forest.fit(cloud.limit(9), FEATURES) is None
    with pytest.raises(ValueError, match="at least 2"):
        forest.fit(cloud.select("a"))
    row = forest.check_rows(cloud.select("a")).first()
    assert row["check"] == "iforest_insufficient_features" and row["passed"]


def test_mean_path():
    assert [forest.mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert forest.mean_path(256) == pytest.approx(10.244770920, rel=1e-6)


def test_anomaly_report(cloud, spark):
    rows = anomaly_checks(cloud.drop("id"), "cloud", as_of="2026-02-01")
    found = by(rows, "check")
    assert {"iqr_outliers_a", "zscore_b", "modified_zscore_c", "isolation_forest"} <= set(found)
    extra = anomaly_checks(
        cloud.select("a"),
        with_forest=False,
        detectors=[lambda df: df.selectExpr("'mine' AS dimension", "'rows' AS check", "CAST(NULL AS STRING) AS column", "count(*) > 0 AS passed", "1D AS score", "0D AS threshold", "'{}' AS details")],
    )
    assert "rows" in by(extra, "check")
    empty = anomaly_checks(cloud.limit(0)).collect()
    assert [(r["dimension"], r["check"]) for r in empty] == [("pipeline", "empty_dataset")]


def test_stored_scores_are_those_of_the_rows(spark):
    """The check is read off the scores that the threshold was found in."""
    df = spark.range(600).selectExpr("id", "CAST(id % 37 AS DOUBLE) AS a", "IF(id % 50 = 0, NULL, CAST(id % 11 AS DOUBLE)) AS b", "IF(id < 3, 1e6, CAST(id % 5 AS DOUBLE)) AS c")
    model = forest.fit(df.drop("id"), trees=20)
    stored, scored = forest.summary(model.fitted(), model).first(), forest.summary(model.transform(df), model).first()
    assert stored.asDict() == pytest.approx({k: v for k, v in scored.asDict().items()}, rel=1e-9)
    assert model.fitted().count() == 600
