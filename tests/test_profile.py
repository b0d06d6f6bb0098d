from __future__ import annotations

import math

import pytest

from plumbline.operators import profile, reports
from plumbline.plans.catalog import catalog, catalog_columns, cross_table


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(1000).selectExpr(
        "id",
        "CASE WHEN id < 400 THEN 'A' WHEN id < 700 THEN 'B' WHEN id < 900 THEN 'C' ELSE 'D' END AS category",
        "CASE WHEN id % 10 < 3 THEN NULL ELSE id END AS gappy",
        "CASE WHEN id % 10 = 0 THEN CAST(id AS DOUBLE) ELSE 0D END AS sparse",
        "CAST(-id AS DOUBLE) AS negative",
        "id % 2 = 0 AS flag",
        "TIMESTAMP '2026-01-01 06:00:00' + make_dt_interval(CAST(id % 100 AS INT), 0, CASE WHEN id % 100 = 99 THEN -1 ELSE 0 END) AS seen",
        "'' AS blank",
    )


def test_base_profile(table):
    found = by(profile.base_profile(table), "column")
    assert found["gappy"]["null_count"] == 300 and found["gappy"]["null_rate"] == 0.3
    assert found["gappy"]["distinct_count"] == 700 and found["gappy"]["cardinality_ratio"] == 0.7
    assert found["blank"]["null_count"] == 0, "an empty string is a value"
    assert [found[c]["kind"] for c in ("flag", "seen", "category")] == ["numeric", "datetime", "categorical"]
    assert found["category"]["distinct_count"] == 4


def test_long_texts_are_told_apart(spark):
    df = spark.range(60).selectExpr("concat(repeat('x', 500), CAST(id % 20 AS STRING)) AS text", "repeat('y', CAST(id AS INT)) AS any")
    found = by(profile.base_profile(df), "column")
    assert (found["text"]["distinct_count"], found["any"]["distinct_count"]) == (20, 60)


def test_approximate_profile_is_close(table):
    exact, approx = by(profile.base_profile(table), "column"), by(profile.base_profile(table, "approx"), "column")
    for name, row in exact.items():
        assert approx[name]["null_count"] == row["null_count"]
        assert approx[name]["distinct_count"] == pytest.approx(row["distinct_count"], rel=0.15)
    with pytest.raises(ValueError, match="mode"):
        profile.base_profile(table, "rough")


def test_numeric_profile(table):
    found = by(profile.numeric_profile(table), "column")
    assert (found["id"]["median"], found["id"]["p25"], found["id"]["iqr"]) == (499.5, 249.75, 499.5)
    assert found["sparse"]["zeros"] == 901 and found["negative"]["negatives"] == 999
    assert found["flag"]["mean"] == 0.5 and "category" not in found


def test_moments_are_bias_corrected(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, 5D, 1D), (2D, 5D, 2D), (3D, 5D, 9D), (4D, 5D, NULL), (10D, 5D, NULL) AS t(x, same, few)")
    found = by(profile.moment_profile(df), "column")
    values = [1, 2, 3, 4, 10]
    n, mean = 5, 4.0
    m2, m3, m4 = (sum((v - mean) ** k for v in values) / n for k in (2, 3, 4))
    g1, g2 = m3 / m2**1.5, m4 / m2**2 - 3
    assert found["x"]["skewness"] == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2))
    assert found["x"]["kurtosis"] == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    assert (found["same"]["skewness"], found["same"]["kurtosis"]) == (0.0, 0.0)
    assert (found["few"]["skewness"], found["few"]["kurtosis"]) == (0.0, 0.0)


def test_top_values_and_entropy(table):
    top = [(r["rank"], r["value"], r["copies"], r["percentage"]) for r in profile.top_values(table).filter("column = 'category'").orderBy("rank").collect()]
    assert top == [(1, "A", 400, 40.0), (2, "B", 300, 30.0), (3, "C", 200, 20.0), (4, "D", 100, 10.0)]
    row = by(profile.entropy_profile(table), "column")
    share = [0.4, 0.3, 0.2, 0.1]
    entropy = -sum(p * math.log(p + 1e-10) for p in share)
    assert row["category"]["entropy"] == round(entropy, 4)
    assert row["category"]["normalized_entropy"] == round(entropy / math.log(4), 4)
    assert row["blank"]["normalized_entropy"] == 0.0 and row["category"]["top_value_share"] == 40.0


def test_ties_are_ordered_by_value(spark):
    df = spark.sql("SELECT * FROM VALUES ('b'), ('a'), ('c'), ('c') AS t(x)")
    assert [r["value"] for r in profile.top_values(df, 2).orderBy("rank").collect()] == ["c", "a"]
    assert [r["value"] for r in reports.top_values(df, "x", 3).collect()] == ["c", "a", "b"]


def test_datetime_range_counts_elapsed_days(table):
    row = by(profile.datetime_profile(table), "column")["seen"]
    assert row["range_days"] == 98, "99 calendar days apart but a minute short of the last one"


def test_samples_use_numeric_order(spark):
    df = spark.range(8, 13).selectExpr("id", "CAST(id AS STRING) AS text")
    rows = profile.samples(df, 3).collect()
    order = {c: [r["value"] for r in sorted(rows, key=lambda r: r["rank"]) if r["column"] == c] for c in ("id", "text")}
    assert order == {"id": ["8", "9", "10"], "text": ["10", "11", "12"]}


def test_flags(table):
    found = {(r["column"], r["flag"]): r for r in profile.quality_flags(table).collect()}
    assert found["gappy", "missing"]["severity"] == "critical" and found["gappy", "missing"]["message"] == "empty in 30.0% of the rows"
    assert found["sparse", "mostly_zero"]["message"] == "zero in 90% of the filled cells"
    assert found["negative", "mostly_negative"]["message"] == "below zero in 999 of 1000 filled cells"
    assert found["category", "low_cardinality"]["severity"] == "info"
    assert ("sparse", "skewed") in found and ("id", "high_cardinality") not in found
    text_key = profile.quality_flags(table.selectExpr("CAST(id AS STRING) AS key")).collect()
    assert [r["flag"] for r in text_key] == ["high_cardinality"]


def test_table_profile(table, spark):
    row = profile.table_profile(table, "t").first()
    assert (row["row_count"], row["column_count"], row["health"]) == (1000, 8, "critical")
    assert row["types"] == "bigint:2,boolean:1,double:2,string:2,timestamp:1"
    empty = profile.table_profile(table.limit(0), "none").first()
    assert (empty["row_count"], empty["column_count"], empty["health"]) == (0, 0, "empty")
    assert profile.table_profile(table.select("id"), "ids").first()["health"] == "good"


def test_table_size(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 'äb', array(1)), (2L, NULL, NULL) AS t(i, s, a)")
    row = profile.table_size(df, "t").first()
    assert row["size_bytes"] == 16 + 3 + len('{"a":[1]}') + len("{}") and row["size"] == f"{row['size_bytes']} B"
    assert profile.table_size(spark.range(1000), "ids").first()["size"] == "7.8 KB"


def test_catalog_skips_absent_tables(table, spark):
    found = by(catalog({"a": table, "b": spark.range(3), "c": None}), "table_name")
    assert set(found) == {"a", "b"} and found["b"]["row_count"] == 3
    assert catalog_columns({"a": table, "c": None}).count() == 8


def test_cross_table(table, spark):
    row = cross_table(table, spark.range(800).selectExpr("id", "1 AS other")).first()
    assert (row["shared_columns"], row["right_only"], row["row_count_diff"], row["row_count_diff_pct"]) == ("id", "other", 200, 25.0)
    assert cross_table(table, spark.range(0)).first()["row_count_diff_pct"] == 0.0


def test_histogram_includes_the_maximum(spark):
    df = spark.range(0, 101).selectExpr("CAST(id AS DOUBLE) AS x")
    rows = reports.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [10] * 9 + [11]
    assert (rows[0]["bin_start"], rows[-1]["bin_end"]) == (0.0, 100.0)
    constant = reports.histogram(spark.range(5).selectExpr("7 AS x"), "x").collect()
    assert [(r["bin"], r["count"]) for r in constant] == [(1, 5)]


def test_filters(spark):
    df = spark.sql("SELECT * FROM VALUES ('2026-01-01', 'a'), ('2026-01-02 23:00:00', 'b'), ('x', 'a'), ('2026-01-03', NULL) AS t(order_date, kind)")
    assert reports.filtered(df, "2026-01-01", "2026-01-02", {"kind": []}).count() == 2
    assert reports.filtered(df, "2026-01-01", "2026-01-03", {"kind": ["a"]}).count() == 1
    domains = {(r["domain"], r["value"]) for r in reports.filter_domains(df, ["kind"]).collect()}
    assert domains == {("min_date", "2026-01-01"), ("max_date", "2026-01-03"), ("kind", "a"), ("kind", "b")}
    assert reports.preview(df, 2).count() == 2
    first = df.columns[0]
    assert [r[0] for r in reports.preview(df, 2, [first]).collect()] == [r[0] for r in df.orderBy(first).limit(2).collect()]
