"""Shape of the physical plans, and results when no side of a join is small enough to broadcast."""

from __future__ import annotations

import pytest

from plumbline.operators import completeness, consistency, outliers, profile, uniqueness, validity


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def items(spark, data_folder):
    return spark.read.parquet(f"{data_folder}/lineitem.parquet")


def test_fused_checks_scan_once(items):
    text = plan(completeness.null_rates(items))
    assert text.count("FileScan") == 1 and "Join" not in text and "Expand" not in text


def test_range_check_reads_only_its_columns(items):
    from plumbline.config import Thresholds

    text = plan(validity.ranges(items, Thresholds(ranges={"l_quantity": (1, 50)})))
    assert "ReadSchema: struct<l_quantity:double>" in text


def test_top_values_are_limited_before_the_shuffle(items):
    assert "WindowGroupLimit" in plan(profile.top_values(items)).split("Exchange")[1]
    bounds = outliers.fit(items, ["l_extendedprice"], ("zscore",), z_limit=1.0)
    assert "WindowGroupLimit" in plan(outliers.outlier_samples(items, bounds))


def test_wide_rows_are_shuffled_as_digests(items):
    text = plan(uniqueness.exact_duplicates(items))
    assert "sha2" in text and text.count("Exchange") == 2
    assert "sha2" not in plan(uniqueness.exact_duplicates(items.select("l_orderkey", "l_linenumber")))


def test_no_cross_joins(items, spark, data_folder):
    orders = spark.read.parquet(f"{data_folder}/orders.parquet").withColumnRenamed("o_orderkey", "l_orderkey")
    for df in (
        consistency.orphan_rows(items, orders, "l_orderkey"),
        profile.entropy_profile(items),
        profile.quality_flags(items),
        outliers.outliers(items, "modified_zscore", ["l_quantity"]),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hot_keys_in_sort_merge_joins(spark):
    """A third of the rows share one key, another third is null, and nothing may be broadcast."""
    key = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE CAST(id AS STRING) END"
    df = spark.range(30_000).selectExpr(f"{key} AS customer_id", "'c' AS shipping_city", f"coalesce({key}, 's') AS shipping_state")
    reference = spark.range(0, 30_000, 2).selectExpr("CAST(id AS STRING) AS customer_id")
    mapping = spark.sql("SELECT 'c' AS key, 's' AS value")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Known are the even ids that are 2 modulo 3: one in six.
        assert consistency.referential(df, reference).first()["orphan_records"] == 25_000
        orphans = consistency.orphan_rows(df, reference, "customer_id")
        assert "SortMergeJoin" in plan(orphans) and orphans.count() == 25_000
        assert consistency.mapping(df, mapping).first()["mismatched"] == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
