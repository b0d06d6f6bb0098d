"""Edges: wide tables, constant and infinite columns, absent columns, summer time, equal file names, missing tokens."""

from __future__ import annotations

import json
import math
import time

import pytest
from pyspark.sql import functions as F

from plumbline.config import Roles, Thresholds, alert_rules
from plumbline.operators import drift, forest, history, outliers, profile, reports, uniqueness
from plumbline.sources.readers import read_source, scan_snapshots, schema_inspect


def test_wide_tables_stay_within_time(spark):
    wide = spark.range(200).select(*[(F.col("id") * (k + 1) % 97).cast("double").alias(f"c{k}") for k in range(300)])
    start = time.time()
    assert profile.moment_profile(wide).count() == 300
    assert profile.table_profile(wide, "wide").first()["column_count"] == 300
    assert schema_inspect(wide).count() == 300
    assert time.time() - start < 180, "it did not end at all before wide tables were split"


def test_constant_columns_give_no_outliers(spark):
    flat = spark.range(20).selectExpr("id % 1 + 5 AS a", "CAST(7 AS DOUBLE) AS b")
    for method in outliers.METHODS:
        found = outliers.outliers(flat, method)
        assert found.count() == 0 and {"column", "outlier_count", "passed"} <= set(found.columns)
    assert reports.outliers_by_column(flat).count() == 0
    with pytest.raises(ValueError):
        outliers.outliers(spark.range(3).selectExpr("CAST(id AS STRING) AS t"), "iqr")


def test_infinite_values_have_no_bin(spark):
    df = spark.sql("SELECT * FROM VALUES (1D), (2D), (3D), (DOUBLE('Infinity')), (DOUBLE('-Infinity')), (DOUBLE('NaN')) AS t(x)")
    rows = reports.histogram(df, "x").collect()
    assert sorted(r["count"] for r in rows if r["bin"]) == [1, 1, 1]
    assert {r["bin_start"] for r in rows if r["bin"] is None} == {math.inf, -math.inf}


def test_timeline_skips_absent_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', 5), (1, 'a', 999), (2, 'b', 1) AS t(day, order_id, quantity)")
    rows = {r["snapshot"]: r.asDict() for r in reports.quality_timeline(df).collect()}
    assert rows[1]["duplicate_rate"] == 0.5 and rows[1]["outlier_qty"] == 0.5 and rows[2]["avg_order_value"] is None
    assert "null_email" not in rows[1]


def test_all_categories_are_found(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'x'), (1, 'y'), (2, 'z'), (2, NULL) AS t(day, product_category)")
    assert {r["snapshot"]: (r["x"], r["y"], r["z"]) for r in reports.category_share(df).collect()} == {1: (0.5, 0.5, 0.0), 2: (0.0, 0.0, 1.0)}


def test_digests_and_values_agree_in_zones_with_summer_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT * FROM VALUES (TIMESTAMP'2025-11-02 05:30:00Z', 'a'), (TIMESTAMP'2025-11-02 06:30:00Z', 'a') AS t(at, x)")
        for method in ("values", "digest", "auto"):
            assert uniqueness.exact_duplicates(df, method=method).first()["duplicate_rows"] == 0
        assert {r["column"]: r["distinct_count"] for r in profile.base_profile(df).collect()} == {"at": 2, "x": 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nothing_is_cut_by_default(spark):
    rows = spark.range(500).selectExpr("TIMESTAMP'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts", "0.5D AS overall_score")
    assert history.recent(rows, "2026-01-22").count() == 500
    series = spark.range(400).selectExpr("'m' AS metric", "id AS snapshot", "CASE WHEN id % 8 = 7 THEN 100D ELSE CAST(id % 2 AS DOUBLE) END AS value")
    summary = drift.drift_summary(series).first()
    assert len(summary["alerts"]) == summary["drift_events"] > 20


def test_the_forest_sees_the_whole_table(spark):
    cloud = spark.range(30_000).selectExpr("id", "sin(id) AS x", "cos(id * 1.7D) AS y")
    model = forest.fit(cloud, ["x", "y"], key=["id"], trees=20, sample_per_tree=64)
    share = model.transform(cloud).agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0]
    assert share == pytest.approx(0.05, abs=0.002)
    again = forest.fit(cloud.repartition(5), ["x", "y"], key=["id"], trees=20, sample_per_tree=64)
    assert again.offset == model.offset


def test_equal_file_names_in_two_folders_are_two_snapshots(spark, tmp_path):
    for folder, value in (("a", 1), ("b", 2)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "orders 1+1.csv").write_text(f"x\n{value}\n")
    df = scan_snapshots(spark, f"{tmp_path}/*/*.csv")
    assert sorted((r["day"], r["x"]) for r in df.collect()) == [(1, 1), (2, 2)]


def test_missing_tokens_leave_the_types_of_columns(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,big,d,day,at,flag,text,none\n10,5000000000,1.5,2026-01-02,2026-01-02 03:04:05,true,NA,NA\nNA,1,n/a,NULL,NA,NA,abc,\n30,NA,2,2026-01-03,2026-01-03 00:00:00,FALSE,007x,null\n")
    df = read_source(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string"]
    assert [r["i"] for r in df.collect()] == [10, None, 30]


def test_thresholds_of_other_stores_and_rule_files(tmp_path):
    with pytest.raises(ValueError):
        Thresholds.load("s3a://bucket/limits.json")
    (tmp_path / "rules.json").write_text(json.dumps({"rules": {"any_failures": {"enabled": False}, "daily_summary": False}}))
    rules = alert_rules(str(tmp_path / "rules.json"))
    assert not rules["any_failures"] and not rules["daily_summary"] and rules["critical_score"]
    assert Roles().keys == ("order_id",)
