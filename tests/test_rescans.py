"""What is behind a table runs once, however many scans an operator makes of it."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumbline.functions.lineage import kept, written
from plumbline.operators import drift, forest, outliers, profile, reports
from plumbline.plans.anomaly import anomaly_checks
from plumbline.plans.incremental import QualityStore
from workload import fixture, queries

ROWS = 400


@pytest.fixture
def counted(spark):
    """A table and the number of rows that were computed of it so far."""
    computed = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    rows = spark.range(ROWS, numPartitions=2).selectExpr("id", "CAST(id % 37 AS DOUBLE) AS a", "IF(id % 50 = 0, NULL, CAST(id * id % 101 AS DOUBLE)) AS b")
    return rows.mapInArrow(through, rows.schema), computed


@pytest.mark.parametrize(
    "run",
    [
        lambda df: outliers.fit(df),
        lambda df: outliers.outliers(df, "modified_zscore").collect(),
        lambda df: outliers.outlier_samples(*(lambda m: (m, outliers.fit(m, stored=True)))(outliers.measured(df))).collect(),
        lambda df: reports.outliers_by_column(df).collect(),
        lambda df: profile.numeric_profile(df).collect(),
        lambda df: forest.fit(df, ["a", "b"], ["id"], trees=5, sample_per_tree=32),
        lambda df: anomaly_checks(df, with_forest=False).collect(),
    ],
    ids=["fit", "outliers", "samples", "by_column", "profile", "forest", "report"],
)
def test_rows_are_computed_once(counted, run):
    df, computed = counted
    run(df)
    assert computed.value == ROWS


def test_rows_are_computed_once_for_detectors_of_known_columns(counted):
    def large(df):
        row = df.selectExpr("count_if(b > 50) AS n", "count(*) AS rows")
        return row.selectExpr("'own' AS dimension", "'large' AS check", "'b' AS column", "n > 0 AS passed", "n / rows AS score", "0D AS threshold", "to_json(struct(n, rows)) AS details")

    df, computed = counted
    known = anomaly_checks(df, with_forest=False, detectors=[large], as_of="2026-02-01", detector_columns=["b"]).collect()
    assert computed.value == ROWS
    assert sorted(known, key=str) == sorted(anomaly_checks(df, with_forest=False, detectors=[large], as_of="2026-02-01").collect(), key=str)


def test_medians_are_found_in_one_pass(counted):
    df, computed = counted
    filled = outliers.median_impute(df, ["a", "b"])
    assert computed.value == ROWS
    assert filled.where("b IS NULL").count() == 0


def test_kept_columns_are_the_same(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DOUBLE('NaN'), NULL), (NULL, -0D, 'x'), (1, DOUBLE('NaN'), NULL) AS t(`a.b c`, `(x)`, s)")
    found = kept(df)
    assert found.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, df.collect()))
    assert kept(df, ["s"]).columns == ["s"] and kept(df, []).columns == []
    assert kept(spark.sql("SELECT NULL AS v, 1 AS x")).count() == 1


def test_snapshot_metrics_compute_the_table_once(counted):
    df, computed = counted
    metrics = drift.snapshot_metrics(df.selectExpr("id % 3 AS day", "a AS total_amount", "CAST(b AS STRING) AS product_category")).collect()
    assert computed.value == ROWS and len(metrics) == 3 and sum(r["order_count"] for r in metrics) == ROWS


class Given:
    """Orders in place of those of the workload."""

    def __init__(self, orders):
        self.orders = orders

    def dirty_orders(self):
        return self.orders

    def dirty_table(self):
        return self.orders.drop("day")


def test_the_report_and_its_drift_compute_the_orders_once(counted):
    df, computed = counted
    orders = df.selectExpr("id % 9 AS day", "a AS total_amount", "b AS unit_price", "CAST(a AS STRING) AS product_category", "IF(id % 7 < id % 9, NULL, 'x') AS customer_email")
    found = queries._anomaly(Given(orders)).collect()
    assert computed.value == ROWS
    series = drift.metric_series(drift.snapshot_metrics(orders))
    expected = anomaly_checks(orders.drop("day"), "dirty_orders", series, with_forest=False, as_of=fixture.AS_OF).collect()
    assert sorted(r[:6] for r in found) == sorted(r[:6] for r in expected)
    assert any(r["dimension"] == "anomaly_drift" for r in found)


def test_metrics_read_their_inputs_only(spark):
    rows = "(1, '', DOUBLE('NaN'), 1, 'p', 2D), (1, NULL, NULL, 999, NULL, 3D), (2, 'y', 999999D, NULL, 'q', NULL), (NULL, NULL, 1D, 999, 'q', 1D)"
    df = spark.sql(f"SELECT *, 7 AS other, 8 AS more FROM VALUES {rows} AS t(day, customer_email, unit_price, quantity, product_category, total_amount)")
    inputs = drift.metric_inputs(df, others=["more"])
    assert set(df.columns) - set(inputs.columns) == {"other"} and dict(inputs.dtypes)["customer_email"] == "boolean"
    metrics = [sorted(drift.snapshot_metrics(t).collect(), key=str) for t in (df, inputs)]
    assert metrics[0] == metrics[1] and len(metrics[0]) == 3


def test_the_forest_keeps_what_its_query_shows(spark):
    orders = spark.range(40).selectExpr("CAST(id AS STRING) AS order_id", "CAST(id % 7 AS STRING) AS customer_id", "id % 11 AS quantity", "id * 1D AS total_amount")
    assert "customer_id" not in queries._forest(Given(orders))[0].columns
    assert "customer_id" in queries._forest(Given(orders), "customer_id")[0].columns


def test_absorbing_snapshots_computes_them_once(spark, counted, tmp_path):
    df, computed = counted
    store = QualityStore(spark, str(tmp_path), "rescans", buckets=8)
    store.absorb(df.selectExpr("id % 3 AS day", "CAST(id DIV 2 AS STRING) AS order_id", "a AS total_amount"))
    assert computed.value == ROWS
    assert store.stores["key_order_id"].counts().selectExpr("sum(rows)").first()[0] == ROWS


def test_tasks_hold_a_bounded_number_of_line_items(spark, data_folder, monkeypatch):
    monkeypatch.setattr(fixture, "ROWS_PER_TASK", 200)
    items = fixture.Tables(spark, data_folder)._line_items()
    assert items.rdd.getNumPartitions() == -(-items.count() // 200)
    sizes = items.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 4 * 200


def test_line_items_are_not_dealt_by_customer(spark, data_folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture.Tables(spark, data_folder).dirty_table()._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("Join Inner, (l_orderkey") < plan.index("Join Inner, (o_custkey")


def _shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {p.name for d in manager.localDirs() for p in Path(d.getPath()).rglob("shuffle_*.data")}


@pytest.mark.parametrize("setting", [None, "false"])
def test_a_written_table_leaves_no_shuffle_files(spark, setting):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, counts = _shuffle_files(spark), spark.range(ROWS).groupBy(F.expr("id % 9 AS k")).count()
    outer = spark.conf.get(name, None)
    spark.conf.unset(name) if setting is None else spark.conf.set(name, setting)
    try:
        found = written(counts)
        assert _shuffle_files(spark) <= before
        assert spark.conf.get(name, None) == setting
    finally:
        spark.conf.unset(name) if outer is None else spark.conf.set(name, outer)
    assert sorted(found.collect()) == sorted(counts.collect())
