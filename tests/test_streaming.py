from __future__ import annotations

from datetime import datetime, timedelta


import numpy as np
import pytest

from plumbline.operators import drift
from plumbline.plans.quality import quality_checks
from plumbline.streaming.drift import drift_points, events_of, rocksdb_state
from plumbline.streaming.monitor import monitor, watch_drift
from plumbline.streaming.windows import deduplicated, windowed_metrics


@pytest.fixture(scope="module")
def events(spark, data_folder):
    return spark.read.parquet(f"{data_folder}/events.parquet")


@pytest.fixture
def stream(spark, events, tmp_path):
    folder = str(tmp_path / "events")
    # One file after the other, as a stream reads files in the order they were written.
    for first, last in ((1, 10), (11, 20), (21, 31)):
        events.filter(f"day(ts) BETWEEN {first} AND {last}").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


METRICS = {"time": "ts", "value": "value", "bounds": (0.0, 100.0), "nulls_of": ["user_id"]}


def test_closed_windows_equal_the_batch_result(spark, events, stream, tmp_path):
    windows = windowed_metrics(stream, **METRICS, delay="1 day")
    out = str(tmp_path / "out")
    query = windows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out)
    query.awaitTermination(120)
    found = {r["window_start"]: r for r in spark.read.parquet(out).collect()}
    expected = {r["window_start"]: r for r in windowed_metrics(events, **METRICS).collect()}
    assert 25 <= len(found) < len(expected), "the last windows are still open"
    for start, row in found.items():
        assert (row["rows"], row["out_of_range_rate"]) == (expected[start]["rows"], expected[start]["out_of_range_rate"])
        assert row["mean_value"] == pytest.approx(expected[start]["mean_value"])


def test_monitor_stores_checks_and_reports_per_batch(spark, stream, tmp_path):
    path = str(tmp_path / "out")
    query = monitor(stream, lambda batch: quality_checks(batch, "events", as_of="2026-02-01"), path, str(tmp_path / "cp"))
    query.awaitTermination(240)
    reports = spark.read.parquet(f"{path}/reports")
    assert reports.count() == 3 and reports.select("batch_id").distinct().count() == 3
    checks = spark.read.parquet(f"{path}/checks").filter("check = 'null_rate_value'")
    rows = checks.selectExpr("get_json_object(details, '$.total_rows') AS n").collect()
    assert sum(int(r["n"]) for r in rows) == 1000


def test_duplicates_within_the_watermark_are_dropped(spark, events, tmp_path):
    folder = str(tmp_path / "twice")
    events.unionByName(events).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).parquet(folder)
    query = (
        deduplicated(stream, ["event_id"], "ts", "40 days")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_drift_over_closed_windows(spark, events, stream, tmp_path):
    metrics = {k: v for k, v in METRICS.items() if k != "nulls_of"}
    path = str(tmp_path / "out")
    query = watch_drift(windowed_metrics(stream, **metrics, delay="1 day"), path, str(tmp_path / "cp"))
    query.awaitTermination(240)
    closed = {r["window_start"] for r in spark.read.parquet(f"{path}/windows").collect()}
    batch = windowed_metrics(events, **metrics).withColumnRenamed("window_start", "snapshot")
    expected = {
        (r["metric"], r["snapshot"]) for r in drift.drift_events(drift.metric_series(batch)).collect() if r["snapshot"] in closed
    }
    assert {(r["metric"], r["snapshot"]) for r in spark.read.parquet(f"{path}/drift_events").collect()} == expected


def _keys(df):
    return {(r["metric"], r["snapshot"]) for r in df.collect()}


def _arrivals(spark, rows, folder):
    """One file per batch of rows (metric, snapshot, value)."""
    for k, batch in enumerate(rows):
        spark.createDataFrame(batch, "metric string, snapshot timestamp, value double").coalesce(1).write.mode("append").parquet(f"{folder}/b={k}")


def test_stateful_drift_equals_the_batch_form_after_a_restart(spark, tmp_path):
    """Rings of values survive between runs; nulls, constant metrics and several points in one batch included."""
    random = np.random.default_rng(5)
    days = [datetime(2026, 1, 1) + timedelta(days=d) for d in range(40)]
    value = {
        "noisy": lambda d: float(random.normal(0, 1) + (30 if d in (12, 29) else 0)),
        "constant": lambda d: 5.0 if d != 20 else 6.0,
        "holes": lambda d: None if d % 9 == 0 else float(random.normal(0, 1) * (10 if d == 25 else 1)),
        "short": lambda d: 1.0,
    }
    rows = [[(m, days[d], f(d)) for d in part for m, f in value.items() if m != "short" or d < 4] for part in (range(0, 9), range(9, 10), range(10, 24), range(24, 40))]
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for k in range(len(rows)):
        _arrivals(spark, [[*b][:: (-1 if k == 2 else 1)] for b in rows[k : k + 1]], f"{folder}/run{k}")
        stream = spark.readStream.schema("metric string, snapshot timestamp, value double").parquet(f"{folder}/run*/b=*")
        with rocksdb_state(spark):
            query = drift_points(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        query.awaitTermination(120)
        assert query.exception() is None
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")
    points = spark.read.parquet(out)
    series = spark.createDataFrame([r for part in rows for r in part], "metric string, snapshot timestamp, value double")
    expected = {(r["metric"], r["snapshot"]): r for r in drift.drift_events(series).collect()}
    found = {(r["metric"], r["snapshot"]): r for r in events_of(points).collect()}
    assert points.count() == series.count() and set(found) == set(expected) and len(expected) >= 3
    for key, row in found.items():
        assert row["z_score"] == pytest.approx(expected[key]["z_score"], rel=1e-6)
        assert row["rolling_mean"] == pytest.approx(expected[key]["rolling_mean"])


def test_silent_metrics_give_a_gap(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = lambda d: datetime(2026, 1, d)
    _arrivals(spark, [[("a", day(1), 1.0), ("b", day(1), 1.0)], [("a", day(2), 1.0)], [("a", day(9), 1.0)], [("a", day(10), 1.0)]], folder)
    stream = spark.readStream.schema("metric string, snapshot timestamp, value double").option("maxFilesPerTrigger", 1).parquet(f"{folder}/b=*")
    with rocksdb_state(spark):
        points = drift_points(stream.withWatermark("snapshot", "0 seconds"), gap="3 days")
        query = points.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out)
    query.awaitTermination(120)
    assert query.exception() is None
    gaps = spark.read.parquet(out).where("kind = 'gap'")
    assert ("b", day(1)) in _keys(gaps) and all(r["alert"] for r in gaps.collect())
    assert _keys(events_of(spark.read.parquet(out))) == set()


def test_watched_windows_are_written_once(spark, events, stream, tmp_path):
    """Every batch writes its own windows and events, none those of an earlier one."""
    metrics = {k: v for k, v in METRICS.items() if k != "nulls_of"}
    path = str(tmp_path / "out")
    query = watch_drift(windowed_metrics(stream, **metrics, delay="1 day"), path, str(tmp_path / "cp"))
    query.awaitTermination(240)
    windows = spark.read.parquet(f"{path}/windows")
    assert windows.count() == windows.select("window_start").distinct().count()
    assert windows.select("batch_id").distinct().count() >= 2
