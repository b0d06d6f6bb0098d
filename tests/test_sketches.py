"""Stored sketches: rank error, merging, replacement, and what a new snapshot reads."""

from __future__ import annotations

import numpy as np
import pytest

from plumbline.operators import outliers, sketches
from plumbline.operators.quantiles import rank_error

N = 40_000


def _samples() -> dict[str, np.ndarray]:
    random = np.random.default_rng(11)
    return {
        "skewed": np.exp(random.normal(0, 3, N)),
        "constant": np.full(N, 4.5),
        "hot": np.where(random.random(N) < 0.4, 7.0, random.integers(0, 1000, N).astype(float)),
        "signed": random.normal(-5, 1, N),
    }


@pytest.fixture(scope="module")
def frame(spark):
    samples = _samples()
    rows = [(i % 6, *(float(v) for v in row)) for i, row in enumerate(zip(*samples.values(), strict=True))]
    schema = "day int, " + ", ".join(f"{c} double" for c in samples)
    return spark.createDataFrame(rows, schema).selectExpr("*", "CAST(NULL AS DOUBLE) AS nothing").repartition(5).cache()


@pytest.mark.parametrize("size", [256, 4096])
def test_rank_error_of_merged_snapshots(frame, size):
    kept = sketches.snapshot_sketches(frame, size=size)
    probabilities = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = {r["column"]: r for r in sketches.quantiles(kept, probabilities).collect()}
    assert set(found) == set(_samples())
    for name, values in _samples().items():
        assert found[name]["values"] == N
        for p, q in zip(probabilities, found[name]["quantiles"], strict=True):
            below, through = (values < q).mean(), (values <= q).mean()
            assert max(below - p, p - through) <= 2 * rank_error(size), (name, p)


def test_iqr_from_sketches_agrees_with_the_rows(frame):
    found = {r["column"]: r for r in sketches.verified(frame, sketches.iqr_outliers(sketches.snapshot_sketches(frame))).collect()}
    exact = {r["column"]: r for r in outliers.outliers(frame.drop("day"), "iqr").collect()}
    assert set(found) == set(exact) == {"skewed", "hot", "signed"}, "a constant column has no spread"
    for name, row in found.items():
        assert max(row["q1_rank_off"], row["q3_rank_off"]) <= 2 * row["rank_error"]
        assert abs(row["outlier_rate"] - row["actual_rate"]) <= 4 * row["rank_error"]
        assert row["outlier_rate"] == pytest.approx(exact[name]["outlier_rate"], abs=0.01)
        assert row["values_checked"] == N


def test_exact_quantiles_from_sketches(frame):
    found = sketches.exact_quantiles(frame, sketches.snapshot_sketches(frame, size=64), (0.0, 0.1, 0.5, 0.999, 1.0))
    for name, values in _samples().items():
        assert found[name] == pytest.approx(np.quantile(values, (0.0, 0.1, 0.5, 0.999, 1.0)), rel=1e-12), name
    some = sketches.snapshot_sketches(frame.where("day IN (1, 2)"))
    rows = sketches.quantile_rows(frame.where("day IN (1, 2)"), some, {"median": 0.5}).collect()
    assert {r["column"]: r["median"] for r in rows}["signed"] == pytest.approx(np.median(_samples()["signed"][[i for i in range(N) if i % 6 in (1, 2)]]))
    assert {r["column"]: r["median"] for r in rows}["nothing"] is None


def test_wrong_sketches_cost_a_scan_but_no_accuracy(frame):
    """Sketches of other rows point to the wrong place; the counts put it right."""
    from plumbline.operators.quantiles import Summary, exact_from

    wrong = {"signed": Summary(N, -1.0, 1.0, [-1 + 2 * i / 1024 for i in range(1025)])}
    assert exact_from(frame, {"signed": "signed"}, (0.5,), wrong)["signed"] == pytest.approx([np.median(_samples()["signed"])])


def test_a_snapshot_is_replaced_and_others_stay(spark, frame, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.store(sketches.snapshot_sketches(frame.where("day < 4")), path)
    sketches.store(sketches.snapshot_sketches(frame.where("day >= 3")), path)
    values = {(r["snapshot"], r["column"]): r["values"] for r in sketches.load(spark, path).collect()}
    expected = {r["day"]: r["count"] for r in frame.groupBy("day").count().collect()}
    assert len(values) == 6 * 5 and all(values[d, "hot"] == n for d, n in expected.items()) and values[2, "nothing"] == 0


def test_a_range_opens_only_its_own_files(spark, frame, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.store(sketches.snapshot_sketches(frame), path)
    some = sketches.load(spark, path, 2, 3)
    some.collect()
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in scan
    assert all("snapshot=2" in f or "snapshot=3" in f for f in some.select("column").inputFiles()) or len(some.inputFiles()) >= 2
    plan = sketches.snapshot_sketches(frame.where("day = 5"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1 and "Join" not in plan


def test_empty_table_and_no_values(spark):
    empty = spark.sql("SELECT 1 AS day, 2D AS x WHERE false")
    assert sketches.snapshot_sketches(empty).collect() == [] and sketches.iqr_outliers(sketches.snapshot_sketches(empty)).collect() == []
    nothing = spark.sql("SELECT 1 AS day, CAST(NULL AS DOUBLE) AS x, double('NaN') AS y")
    assert sketches.quantiles(sketches.snapshot_sketches(nothing), [0.5]).collect() == []
    assert sketches.verified(nothing, sketches.iqr_outliers(sketches.snapshot_sketches(nothing))).collect() == []


def test_anomaly_fit_takes_three_scans(frame, monkeypatch):
    """Moments and sketches, quartiles, median distances; then the report's own scan."""
    from plumbline.operators import quantiles

    scans = []
    narrow, summarised = quantiles._narrow, outliers._summarised
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: scans.append("narrow") or narrow(*a))
    monkeypatch.setattr(outliers, "_summarised", lambda *a: scans.append("summary") or summarised(*a))
    bounds = outliers.fit(frame.drop("day", "nothing"))
    assert scans == ["summary", "narrow", "narrow"] and {b.column for b in bounds} == {"hot", "signed", "skewed"}
