"""Checks gathered while writing, and profile operators of one or two scans."""

from __future__ import annotations

import random

import pytest

from plumbline.config import Roles, Thresholds
from plumbline.operators import profile
from plumbline.operators.custom import Predicate
from plumbline.plans.materialise import write_checked
from plumbline.plans.quality import quality_checks

ROLES = Roles(keys=(), formats={"mail": ("mail_format", "^[a-z]+@x$")}, event_time="at", arithmetic=())
LIMITS = Thresholds(ranges={"x": (0.0, 10.0)}, max_null_rate={})


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(500).selectExpr(
        "id",
        "IF(id % 13 = 0, '', IF(id % 4 = 0, 'bad', 'ok@x')) AS mail",
        "IF(id % 17 = 0, NULL, IF(id % 19 = 0, double('NaN'), CAST(id % 23 AS DOUBLE) / 2)) AS x",
        "IF(id % 29 = 0, 'no time', CAST(TIMESTAMP '2026-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS STRING)) AS at",
        "CAST(id % 2 AS INT) AS part",
    )


def _rows(df):
    return sorted((r["dimension"], r["check"], r["column"], r["passed"], round(r["score"], 9), r["threshold"], r["details"]) for r in df.collect())


def test_checks_of_the_write_equal_those_of_the_table(spark, table, tmp_path):
    path, rules = str(tmp_path / "t"), [Predicate("validity", "small", "id < 400", 0.5)]
    truth = table.where("x > 1")
    found = write_checked(table, path, "t", truth, LIMITS, ROLES, rules, "2026-02-01", partition_by=["part"])
    expected = quality_checks(table, "t", None, None, truth, LIMITS, ROLES, rules, "2026-02-01").where("dimension <> 'uniqueness' AND check NOT LIKE 'overall%'")
    assert _rows(found) == _rows(expected)
    kept = spark.read.parquet(path)
    assert kept.count() == 500 and kept.where("isnan(x)").count() == table.where("isnan(x)").count()


def test_one_job_reads_the_table_once(spark, table, tmp_path):
    source = str(tmp_path / "source")
    table.coalesce(3).write.parquet(source)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    watched = spark.read.parquet(source)
    watched = watched.mapInArrow(count, watched.schema)
    write_checked(watched, str(tmp_path / "t"), limits=LIMITS, roles=ROLES, as_of="2026-02-01").collect()
    assert reads.value == 500


def test_wide_tables_are_observed_in_parts(spark, tmp_path):
    wide = spark.range(20).selectExpr("id", *[f"IF(id % {i + 2} = 0, NULL, 'v') AS c{i}" for i in range(90)])
    found = write_checked(wide, str(tmp_path / "w"), limits=Thresholds(), roles=ROLES)
    expected = quality_checks(wide, limits=Thresholds(), roles=ROLES).where("dimension = 'completeness' AND check NOT LIKE 'overall%'")
    assert _rows(found.drop("ts")) == _rows(expected.drop("ts")) and found.count() == 91


def test_empty_table(spark, tmp_path):
    found = write_checked(spark.sql("SELECT 1 AS a WHERE false"), str(tmp_path / "e")).collect()
    assert [(r["check"], r["passed"]) for r in found] == [("empty_dataset", False)]


def test_samples_take_one_scan(spark):
    random.seed(2)
    words = [random.choice(["b", "a", "é", "Z", "aa", "10", "9", None, ""]) for _ in range(400)]
    rows = [(w, random.choice([3, 1, None, -7, 10**12, 4, 9]), random.choice([0.0, -0.0, float("nan"), 2.5, 1e7, None])) for w in words]
    df = spark.createDataFrame(rows, "w string, n bigint, d double").selectExpr("*", "CAST(NULL AS STRING) AS nothing", "array(n) AS a").repartition(7)
    found = {}
    result = profile.samples(df, 4)
    for r in result.orderBy("column", "rank").collect():
        found.setdefault(r["column"], []).append(r["value"])
    assert found["w"] == sorted({w for w in words if w is not None}, key=str.encode)[:4]
    assert found["n"] == ["-7", "1", "3", "4"] and found["d"] == ["0.0", "2.5", "1.0E7"] and "nothing" not in found
    assert found["a"] == ["[-7]", "[1000000000000]", "[1]", "[3]"]
    text = result._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ExistingRDD") == 1 and text.count("MapInArrow") == 3
    assert profile.samples(df.where("false")).collect() == []


def test_certain_values_are_the_most_frequent(spark):
    random.seed(3)
    values = [f"v{int(random.paretovariate(0.7))}" for _ in range(20_000)]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "v string, unique string")
    df = df.selectExpr("*", "CAST(NULL AS STRING) AS nothing", "IF(v = 'v1', 'a''b\\\\\\\\', NULL) AS quoted").repartition(6)
    counts = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
    for tracked in (64, 256, 4096):
        found = [r for r in profile.frequent_values(df, tracked=tracked).collect() if r["certain"]]
        mine = [(r["value"], r["copies"]) for r in sorted(found, key=lambda r: r["rank"]) if r["column"] == "v"]
        assert mine == best[: len(mine)] and (tracked < 4096 or len(mine) >= 5), tracked
        assert all(c > max(3.5 / tracked * 20_000, 0) for _, c in mine)
        assert [r["copies"] for r in found if r["column"] == "quoted"] == [counts["v1"]] and not [r for r in found if r["column"] in ("unique", "nothing")]
    assert profile.frequent_values(df.where("false")).collect() == []
