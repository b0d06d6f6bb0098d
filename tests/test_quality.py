"""Quality checks on small frames with results worked out by hand."""

from __future__ import annotations

import json

import pytest

from plumbline.config import Arithmetic, Lookup, Roles, Thresholds
from plumbline.operators import accuracy, checks, completeness, consistency, custom, scoring, timeliness, uniqueness, validity
from plumbline.plans.quality import missing_table_checks, quality_checks

AS_OF = "2026-02-01 00:00:00"


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        ("A1", "a@x.org", 1, 10.0, 10.0, "2026-01-31 00:00:00", 30),
        ("A2", "", 2, 10.0, 20.0, "2026-01-01 00:00:00", None),
        ("A2", None, 999, float("nan"), 5.0, "2027-01-01 00:00:00", 200),
        (None, "bad", 3, 0.0, 1.0, "never", -1),
        (None, "b@y.co", 3, 5.0, 15.0, None, 40),
    ]
    return spark.createDataFrame(
        rows,
        "order_id string, customer_email string, quantity bigint, unit_price double, total_amount double, "
        "order_date string, customer_age int",
    )


def test_null_rates_count_empty_strings_and_nan(small):
    found = by(completeness.null_rates(small, Thresholds()), "column")
    email = found["customer_email"]
    assert (email["null_count"], email["empty_string_count"], email["total_missing"]) == (1, 1, 2)
    assert email["null_rate"] == 0.4 and not email["passed"] and email["score"] == 0.0
    assert found["unit_price"]["null_count"] == 1
    assert found["quantity"]["score"] == 1.0 and found["quantity"]["threshold"] == 0.10


def test_zero_threshold_scores_one(small):
    found = by(completeness.null_rates(small, Thresholds(max_null_rate={"order_id": 0.0})), "column")
    assert found["order_id"]["score"] == 1.0 and not found["order_id"]["passed"]


def test_completeness_overall_uses_unrounded_rates(small):
    row = one(completeness.overall(small, Thresholds()))
    assert row["average"] == pytest.approx((0.4 + 0.4 + 0 + 0.2 + 0 + 0.2 + 0.2) / 7)
    assert row["score"] == pytest.approx(1 - row["average"])


def test_repeated_null_keys_are_duplicates(small):
    row = one(uniqueness.key_duplicates(small))
    assert (row["total_rows"], row["duplicate_keys"], row["duplicate_rate"]) == (5, 2, 0.4)


@pytest.mark.parametrize("method", ["values", "digest", "auto"])
def test_exact_duplicates(spark, method):
    rows = [("ab", "c", 1.0), ("a", "bc", 1.0), ("ab", "c", 1.0), (None, "c", 0.0), (None, "c", -0.0), ("c", None, 0.0), ("", None, 0.0)]
    row = one(uniqueness.exact_duplicates(spark.createDataFrame(rows, "a string, b string, c double"), method=method))
    assert (row["total_rows"], row["duplicate_rows"]) == (7, 2)


def test_exact_duplicates_of_nested_columns(spark):
    df = spark.sql("SELECT map('k', id % 2) AS m, array(id % 2) AS a, CAST(id % 2 AS STRING) AS s FROM range(6)")
    assert one(uniqueness.exact_duplicates(df))["duplicate_rows"] == 4


def test_a_hot_row_is_counted_whole(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS order_id")
    assert one(uniqueness.key_duplicates(df))["duplicate_keys"] == 9_999
    assert one(uniqueness.exact_duplicates(df))["duplicate_rows"] == 9_999


def test_uniqueness_overall_averages_rounded_rates(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id < 2 THEN 0L ELSE id END AS order_id", "id AS other")
    row = one(uniqueness.overall(df))
    assert row["average"] == 0.0 and row["score"] == 1.0


def test_composite_keys_and_missing_keys(spark):
    df = spark.sql("SELECT id % 2 AS a, id % 3 AS b FROM range(12)")
    assert one(uniqueness.key_duplicates(df, roles=Roles(keys=(("a", "b"),))))["duplicate_keys"] == 6
    with pytest.raises(ValueError, match="key columns"):
        uniqueness.key_duplicates(df)


def test_format(small):
    row = one(validity.formats(small))
    assert (row["values_checked"], row["valid"], row["invalid"]) == (4, 2, 2)
    assert row["score"] == pytest.approx(0.5 / 0.9)
    assert [r["value"] for r in validity.invalid_samples(small, "customer_email", Roles().formats["customer_email"][1]).collect()] == ["", "bad"]


def test_format_is_skipped_without_values(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS customer_email")
    assert validity.formats(df).count() == 0


def test_future_dates_may_score_below_zero(small):
    row = one(validity.future_dates(small, as_of=AS_OF))
    assert row["future_dates"] == 1 and row["score"] == pytest.approx(1 - 0.2 / 0.02)
    assert one(validity.future_dates(small, as_of=AS_OF, clamp=True))["score"] == 0.0
    parse = one(validity.parse_rate(small))
    assert (parse["parse_failures"], parse["parse_success_rate"]) == (2, pytest.approx(0.6))


def test_additional_time_formats(spark):
    df = spark.sql("SELECT * FROM VALUES ('31/01/2026'), ('2026-01-30'), ('x') AS t(order_date)")
    assert one(validity.parse_rate(df))["parse_failures"] == 2
    assert one(validity.parse_rate(df, Roles(time_formats=("dd/MM/yyyy",))))["parse_failures"] == 1


def test_ranges_are_inclusive(small):
    found = by(validity.ranges(small), "column")
    assert (found["quantity"]["values_checked"], found["quantity"]["out_of_range"]) == (5, 1)
    assert (found["customer_age"]["values_checked"], found["customer_age"]["out_of_range"]) == (4, 2)
    assert found["unit_price"]["actual_min"] == 0.0 and found["unit_price"]["values_checked"] == 4
    open_ended = by(validity.ranges(small, Thresholds(ranges={"quantity": (2, None)})), "column")
    assert open_ended["quantity"]["out_of_range"] == 1 and open_ended["quantity"]["range_max"] is None


def test_references_compare_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES ('a'), ('a'), ('b'), (NULL), (NULL) AS t(customer_id)")
    known = spark.sql("SELECT * FROM VALUES ('a'), ('a') AS t(customer_id)")
    row = one(consistency.referential(df, known))
    assert (row["total_rows"], row["orphan_records"], row["valid_rate"]) == (5, 3, pytest.approx(0.4))
    with_null = known.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS customer_id"))
    assert one(consistency.referential(df, with_null))["orphan_records"] == 1
    assert [r[0] for r in consistency.orphan_rows(df, with_null, "customer_id").collect()] == ["b"]
    assert consistency.orphan_rows(df, known, "customer_id").count() == 3


def test_arithmetic_tolerance_and_zero_base(small):
    row = one(consistency.arithmetic(small))
    # Complete rows: 1*10=10, 2*10=20, 3*0=0 against 1 (base 1), 3*5=15.
    assert (row["rows_checked"], row["inconsistent_rows"]) == (4, 1)
    loose = Roles(arithmetic=(Arithmetic("amounts", "total_amount", ("quantity", "unit_price"), "quantity * unit_price", 1.0),))
    assert one(consistency.arithmetic(small, loose))["inconsistent_rows"] == 0


def test_mapping_lets_unknown_keys_pass(spark):
    df = spark.sql("SELECT * FROM VALUES ('p', 'x'), ('p', 'y'), ('q', 'z'), (NULL, 'x'), ('p', NULL), ('e', 'v') AS t(c, s)")
    known = spark.sql("SELECT * FROM VALUES ('p', 'x'), ('e', '') AS t(key, value)")
    row = one(consistency.mapping(df, known, Lookup("m", "c", "s")))
    assert (row["rows_checked"], row["mismatched"]) == (4, 1)


def test_timeliness(small):
    fresh = one(timeliness.freshness(small.filter("order_date < '2027'"), as_of=AS_OF))
    assert fresh["hours_since_update"] == 24.0 and fresh["score"] == 0.5 and fresh["passed"]
    future = one(timeliness.freshness(small, as_of=AS_OF))
    assert future["hours_since_update"] < 0 and future["score"] == 1.0
    recent = one(timeliness.recency(small, as_of=AS_OF))
    assert (recent["total_dates"], recent["recent_records"]) == (3, 2)


def test_accuracy_counts_nulls_of_the_truth_only(spark):
    dirty = spark.sql("SELECT * FROM VALUES (1D), (NULL), (3D) AS t(x)")
    truth = spark.sql("SELECT * FROM VALUES (1D), (NULL), (2D), (3D) AS t(x)")
    row = one(accuracy.distributions(dirty, truth))
    assert (row["dirty_count"], row["clean_count"], row["mean_shift"]) == (2, 4, 0.0)
    assert row["dirty_std"] == pytest.approx(2**0.5)
    shifted = one(accuracy.distributions(spark.sql("SELECT 2.2D AS x"), truth))
    assert shifted["mean_shift"] == pytest.approx(0.1) and shifted["score"] == pytest.approx(0.5)


def test_custom_predicates(small):
    rules = [
        custom.Predicate("validity", "adult", "customer_age >= 18", 0.5),
        custom.Predicate("validity", "priced", "unit_price > 0", 0.9, "quantity < 100"),
    ]
    found = by(custom.predicates(small, rules), "check")
    assert (found["adult"]["rows_checked"], found["adult"]["satisfied"]) == (5, 3)
    assert (found["priced"]["rows_checked"], found["priced"]["satisfied"]) == (4, 3)


def test_report_of_a_small_table(small, spark):
    rows = quality_checks(small, "small", as_of=AS_OF, rules=[custom.Predicate("business", "cheap", "total_amount < 100")])
    found = by(rows, "check")
    assert {"overall_completeness", "overall_uniqueness", "overall_timeliness", "email_format", "cheap"} <= set(found)
    assert "overall_accuracy" not in found and "referential_integrity_customer" not in found
    assert json.loads(found["email_format"]["details"])["valid"] == 2
    assert found["cheap"]["dataset"] == "small" and str(found["cheap"]["ts"]) == AS_OF
    assert isinstance(found["email_format"]["passed"], bool)


def test_a_dimension_with_only_an_overall_check_scores_zero(spark):
    df = spark.range(3).selectExpr("id AS order_id")
    rows = quality_checks(df, as_of=AS_OF)
    assert by(rows, "check")["overall_timeliness"]["score"] == 1.0
    assert by(scoring.dimension_scores(rows), "dimension")["timeliness"]["score"] == 0.0
    assert "timeliness" not in by(scoring.dimension_scores(rows, skip_empty=True), "dimension")


def test_empty_and_absent_tables_fail_once(small, spark):
    for rows in (quality_checks(small.limit(0), "none"), missing_table_checks(spark, "none")):
        row = one(rows)
        assert (row["dimension"], row["check"], row["passed"], row["score"]) == ("pipeline", "empty_dataset", False, 0.0)
    report = one(scoring.report(quality_checks(small.limit(0), "none")))
    assert report["overall_score"] == 0.0 and report["status"] == "critical"


def test_wide_tables_are_aggregated_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(checks, "MAX_AGGREGATES", 7)
    df = spark.range(4).selectExpr(*[f"CASE WHEN id < {i % 5} THEN NULL ELSE 'v' END AS `c.{i} x`" for i in range(40)])
    found = by(completeness.null_rates(df), "column")
    assert len(found) == 40 and found["c.3 x"]["null_count"] == 3 and found["c.4 x"]["null_rate"] == 1.0


def test_checks_do_not_depend_on_partitioning(small):
    wanted = ["dimension", "check", "passed", "score"]
    results = [
        sorted(quality_checks(small.repartition(n), as_of=AS_OF).select(*wanted).collect(), key=str) for n in (1, 7, 64)
    ]
    for other in results[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in results[0]]
        assert [r[3] for r in other] == pytest.approx([r[3] for r in results[0]])
