"""Stores that take in one snapshot at a time against the operators over all rows."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from plumbline.config import Roles, Thresholds
from plumbline.operators import checks, uniqueness
from plumbline.operators.custom import Predicate
from plumbline.operators.seen import SeenKeys, cumulative_duplicates
from plumbline.plans.incremental import QualityStore, merged_metrics, metric_states
from plumbline.plans.quality import quality_checks


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    made = SeenKeys(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "seen"), 8).attach()
    yield made
    made.detach()


ROWS = [(1, "a"), (1, "a"), (1, None), (1, None), (2, "a"), (2, "b"), (2, None), (3, "c"), (3, "c"), (3, "c"), (3, "b"), (4, "a")]


def _expected(rows):
    seen, out = set(), {}
    for day, key in sorted(rows, key=lambda r: r[0]):
        n, new = out.get(day, (0, 0))
        out[day] = n + 1, new + (key not in seen)
        seen.add(key)
    return out


@pytest.mark.parametrize("batches", [[(1, 4)], [(1, 1), (2, 2), (3, 3), (4, 4)], [(1, 2), (3, 4)], [(1, 2), (2, 2), (1, 2), (3, 4), (4, 4)]])
def test_repeats_per_snapshot(spark, store, batches):
    """Also when a snapshot is taken in again, as after a failure."""
    df = spark.createDataFrame(ROWS, "day int, k string")
    for first, last in batches:
        store.absorb(df.where(F.col("day").between(first, last)), ["k"], "day")
    found = {r["snapshot"]: (r["rows"], r["new_keys"]) for r in store.counts().collect()}
    assert found == _expected(ROWS)
    last = cumulative_duplicates(store.counts()).orderBy("snapshot").collect()[-1]
    whole = uniqueness.key_duplicates(df.drop("day"), Thresholds(), Roles(keys=("k",))).first()
    assert (last["total_rows"], last["total_repeated"]) == (whole["total_rows"], whole["duplicate_keys"])
    assert store.digests().count() == len({k for _, k in ROWS})


def test_stored_keys_are_not_shuffled(spark, store):
    df = spark.range(3000).selectExpr("id % 3 AS day", "CAST(id % 1100 AS STRING) AS k")
    store.absorb(df.where("day = 0"), ["k"], "day")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = store.first_seen(df.where("day = 1"), ["k"], "day")
        text = plan(met)
        assert met.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # only the new snapshot is dealt, once for its distinct keys and the join together
    assert text.count("Exchange") == 1 and "SortMergeJoin" in text and "Bucketed: true" in text
    assert "Exchange" not in text[text.index("Bucketed: true") - 400 :]


def test_a_snapshot_with_nothing_new_and_an_empty_one(spark, store):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "day int, k string")
    store.absorb(df.where("day = 1"), ["k"], "day")
    store.absorb(df.where("day = 2"), ["k"], "day")
    store.absorb(df.where("day = 3"), ["k"], "day")
    assert {r["snapshot"]: (r["rows"], r["new_keys"]) for r in store.counts().collect()} == {1: (1, 1), 2: (1, 0)}


def test_compaction_and_another_session(spark, store, tmp_path):
    df = spark.createDataFrame(ROWS, "day int, k string")
    for day in (1, 2, 3):
        store.absorb(df.where(F.col("day") == day), ["k"], "day")
    small = store.compact(f"{store.table}_small", str(tmp_path / "small"))
    again = SeenKeys(spark, f"{store.table}_again", str(tmp_path / "small"), 8).attach()
    try:
        again.absorb(df.where("day = 4"), ["k"], "day")
        assert {r["snapshot"]: (r["rows"], r["new_keys"]) for r in again.counts().collect()} == _expected(ROWS)
    finally:
        small.detach()
        again.detach()


ROLES = Roles(keys=("id", ("name", "day2")), formats={"mail": ("mail_format", "^[a-z]+@x$")}, event_time="at", reference=("ref", "name"), arithmetic=())
LIMITS = Thresholds(ranges={"x": (0.0, 10.0)}, max_null_rate={})


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(900).selectExpr(
        "CAST(id % 3 + 1 AS INT) AS day",
        "IF(id % 7 = 0, 1, id) AS id",
        "IF(id % 11 = 0, NULL, concat('n', id % 40)) AS name",
        "CAST(id % 5 AS INT) AS day2",
        "IF(id % 13 = 0, '', IF(id % 4 = 0, 'bad', 'ok@x')) AS mail",
        "IF(id % 17 = 0, NULL, IF(id % 19 = 0, double('NaN'), CAST(id % 23 AS DOUBLE) / 2)) AS x",
        "IF(id % 29 = 0, 'no time', CAST(TIMESTAMP '2026-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS STRING)) AS at",
        "IF(id % 3 = 0, 's1', 's2') AS shipping_state",
        "concat('c', id % 2) AS shipping_city",
    )


def _rows(df):
    return sorted((r["dimension"], r["check"], r["column"], r["passed"], round(r["score"], 9), r["threshold"]) for r in df.collect())


def test_report_of_snapshots_equals_that_of_all_rows(spark, table, tmp_path):
    reference = spark.range(30).selectExpr("concat('n', id) AS name")
    known = spark.sql("SELECT * FROM VALUES ('c0', 's1'), ('c1', 's2') AS t(key, value)")
    truth = table.where("x > 1").drop("day")
    rules = [Predicate("validity", "short_names", "length(name) < 4", 0.5)]
    store = QualityStore(spark, str(tmp_path / "q"), f"q_{uuid.uuid4().hex}", LIMITS, ROLES, rules, as_of="2026-02-01", buckets=8)
    for days in ("day = 1", "day = 2", "day = 3", "day = 2"):
        store.absorb(table.where(days), reference, known)
    expected = quality_checks(table.drop("day"), "t", reference, known, truth, LIMITS, ROLES, rules, as_of="2026-02-01")
    found = store.quality_checks(table, "t", truth)
    assert _rows(found) == _rows(expected)
    details = lambda df: {r["check"]: r["details"] for r in df.collect() if r["dimension"] in ("completeness", "validity", "uniqueness")}
    assert details(found) == details(expected)
    part = store.quality_checks(table, "t", None, through=2)
    some = quality_checks(table.where("day <= 2").drop("day"), "t", reference, known, None, LIMITS, ROLES, rules, as_of="2026-02-01")
    assert _rows(part) == _rows(some)


def test_a_new_snapshot_reads_only_itself(spark, table, tmp_path):
    """Its states come from the files of its own day, and the report from states alone."""
    path = str(tmp_path / "days")
    table.write.partitionBy("day").parquet(path)
    kept = spark.read.parquet(path)
    store = QualityStore(spark, str(tmp_path / "q"), f"q_{uuid.uuid4().hex}", LIMITS, ROLES, as_of="2026-02-01", buckets=8)
    plain = store._plain(kept.drop("day"), None)
    text = plan(metric_states(kept.where("day = 2"), plain, "day"))
    assert text.count("FileScan") == 1 and "PartitionFilters: [isnotnull(day" in text and "Join" not in text
    store.absorb(kept.where("day = 2"))
    report = store.quality_checks(kept, "t", with_reference=False, with_lookup=False)
    assert report.inputFiles() and all("/q/" in f for f in report.inputFiles())


def test_metrics_without_a_mergeable_form_are_refused(spark):
    df = spark.sql("SELECT 1 AS day, 2D AS x")

    def check(expression):
        return checks.Check("validity", "c", {"m": expression}, {}, "true", "1D", 0.0, "true")

    for expression in ("median(x)", "sum(x)", "count(x) + 1"):
        with pytest.raises(ValueError, match="no mergeable form"):
            metric_states(df, [check(expression)], "day")


def test_merged_moments_are_those_of_all_rows(spark):
    df = spark.range(500).selectExpr("id % 7 AS day", "IF(id % 7 = 3, NULL, 1e9 + id * id) AS x")
    check = checks.Check("accuracy", "c", {"a": "avg(x)", "s": "stddev_samp(x)", "lo": "min(x)", "n": "count(x)"}, {}, "true", "1D", 0.0, "true")
    row = merged_metrics(metric_states(df, [check], "day"), [check]).first()
    whole = df.selectExpr("avg(x) AS a", "stddev_samp(x) AS s", "min(x) AS lo", "count(x) AS n").first()
    assert row["a"] == pytest.approx(whole["a"], rel=1e-12) and row["s"] == pytest.approx(whole["s"], rel=1e-9)
    assert (row["lo"], row["n"]) == (whole["lo"], whole["n"])
