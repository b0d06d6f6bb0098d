"""One query per operator over the supplied tables, as (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import Arithmetic, Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import numeric_columns
from plumbline.functions.lineage import kept, scratch
from plumbline.operators import (
    accuracy,
    alerts,
    completeness,
    consistency,
    custom,
    drift,
    forest,
    history,
    outliers,
    profile,
    reports,
    scoring,
    sketches,
    timeliness,
    uniqueness,
    validity,
)
from plumbline.plans import catalog as catalogs
from plumbline.operators.seen import SeenKeys, cumulative_duplicates
from plumbline.plans.anomaly import anomaly_checks
from plumbline.plans.incremental import QualityStore
from plumbline.plans.materialise import write_checked
from plumbline.plans.quality import quality_checks
from plumbline.sources.readers import schema_inspect, union_snapshots
from plumbline.sources.sinks import latest_report
from plumbline.sources.snapshots import read_snapshots
from plumbline.streaming.windows import windowed_metrics
from workload.fixture import AS_OF, Tables

LIMITS = Thresholds()
ROLES = Roles()
CHECK_COLUMNS = ("dataset", "dimension", "check", "column", "passed", "score", "threshold", "ts")
QUALITY_DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency", "timeliness", "accuracy")
ANOMALY_DIMENSIONS = ("anomaly_iqr", "anomaly_zscore", "anomaly_drift")
RULES = [
    custom.Predicate("validity", "positive_total", "total_amount > 0", 0.99),
    custom.Predicate("validity", "plausible_quantity", "quantity BETWEEN 1 AND 100", 0.995),
    custom.Predicate("consistency", "paid_orders_have_city", "shipping_city IS NOT NULL", 0.9, "payment_method IS NOT NULL"),
]

_REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def _query(name: str) -> Callable:
    """Register a query under ``name``."""

    def keep(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        _REGISTRY[name] = build
        return build

    return keep


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and print times, so that results of two engines can be compared by value."""
    out = []
    for f in df.schema.fields:
        column = sql.name(f.name)
        if isinstance(f.dataType, T.DoubleType):
            out.append(sql.alias(f"round({column}, {digits})", f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            out.append(sql.alias(f"CAST({column} AS STRING)", f.name))
        else:
            out.append(column)
    return df.selectExpr(*out)


def detailed(checks: DataFrame) -> DataFrame:
    """The details of checks in rows: check, field, and the value as a number or else as text."""
    cells = checks.selectExpr("check", "inline(map_entries(from_json(details, 'map<string,string>')))")
    time = "value RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}T'"
    number = "try_cast(value AS DOUBLE)"
    text = f"CASE WHEN {time} THEN substr(replace(value, 'T', ' '), 1, 19) WHEN {number} IS NULL THEN value END"
    return comparable(cells.selectExpr("check", "key AS field", f"{number} AS number", f"{text} AS text"))


def with_scores(report: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """A report with a column per dimension in place of the map."""
    scores = [f"dimension_scores['{d}'] AS {d}" for d in dimensions]
    return comparable(report.selectExpr("*", "size(dimension_scores) AS scored", *scores).drop("dimension_scores"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: bound(build) for name, build in _REGISTRY.items()}


# Sources


@_query("schema_inspect")
def _schema_inspection(t: Tables) -> DataFrame:
    return schema_inspect(t.dirty_orders())


@_query("union_snapshots")
def _union_of_snapshots(t: Tables) -> DataFrame:
    orders = t.dirty_orders().select("order_id", "payment_method", "quantity", "day")
    return union_snapshots(
        orders.filter("day <= 10").drop("payment_method"), orders.filter("day BETWEEN 11 AND 20"), orders.filter("day > 20")
    )


@_query("snapshot_scan")
def _snapshot_scan(t: Tables) -> DataFrame:
    # a file per day, as a shop would deliver them, of which three are opened
    folder = scratch(t.spark, "daily")
    columns = ["order_id", "customer_email", "quantity", "total_amount", "order_date"]
    daily = t.dirty_orders().select(*columns, F.expr("lpad(day, 2, '0') AS file"))
    daily.repartition("file").write.option("header", True).option("emptyValue", "").partitionBy("file").csv(folder)
    schema = "order_id string, customer_email string, quantity bigint, total_amount double, order_date timestamp"
    read = read_snapshots(t.spark, f"{folder}/file=*/part-*.csv", schema).where("day BETWEEN 3 AND 5")
    sums = ("count(*) AS rows", "count(customer_email) AS emails", "count(order_date) AS dated", "sum(quantity) AS quantity", "sum(total_amount) AS amount")
    return comparable(read.groupBy("day").agg(*map(F.expr, sums)), 2)


@_query("latest_report")
def _latest_of_reports(t: Tables) -> DataFrame:
    return with_scores(latest_report(score_history(t)), ("completeness",))


# Quality dimensions


@_query("completeness_null_rate")
def _completeness_null_rate(t: Tables) -> DataFrame:
    return comparable(completeness.null_rates(t.dirty_table(), LIMITS))


@_query("completeness_overall")
def _completeness_overall(t: Tables) -> DataFrame:
    return comparable(completeness.overall(t.dirty_table(), LIMITS))


@_query("uniqueness_exact")
def _uniqueness_exact(t: Tables) -> DataFrame:
    return comparable(uniqueness.exact_duplicates(t.dirty_table(), LIMITS))


@_query("uniqueness_key")
def _uniqueness_key(t: Tables) -> DataFrame:
    return comparable(uniqueness.key_duplicates(t.dirty_table(), LIMITS, ROLES))


@_query("uniqueness_composite_key")
def _uniqueness_composite_key(t: Tables) -> DataFrame:
    roles = Roles(keys=(("l_orderkey", "l_linenumber"), "l_orderkey"))
    return comparable(uniqueness.key_duplicates(t.read("lineitem"), LIMITS, roles))


@_query("uniqueness_overall")
def _uniqueness_overall(t: Tables) -> DataFrame:
    return comparable(uniqueness.overall(t.dirty_table(), LIMITS, ROLES))


@_query("duplicate_documents")
def _duplicate_documents(t: Tables) -> DataFrame:
    # Whole texts are compared, by digest, so that the shuffle does not carry them.
    return comparable(uniqueness.key_duplicates(t.read("documents"), LIMITS, Roles(keys=("text",)), method="digest"))


@_query("validity_format")
def _validity_format(t: Tables) -> DataFrame:
    return comparable(validity.formats(t.dirty_table(), LIMITS, ROLES))


@_query("validity_invalid_samples")
def _validity_invalid_samples(t: Tables) -> DataFrame:
    return validity.invalid_samples(t.dirty_table(), "customer_email", ROLES.formats["customer_email"][1])


@_query("validity_future_dates")
def _validity_future_dates(t: Tables) -> DataFrame:
    return comparable(validity.future_dates(t.dirty_table(), LIMITS, ROLES, AS_OF))


@_query("validity_parse_rate")
def _validity_parse_rate(t: Tables) -> DataFrame:
    return comparable(validity.parse_rate(t.dirty_table(), ROLES))


@_query("validity_range")
def _validity_range(t: Tables) -> DataFrame:
    return comparable(validity.ranges(t.dirty_table(), LIMITS))


@_query("validity_overall")
def _validity_overall(t: Tables) -> DataFrame:
    return comparable(validity.overall(t.dirty_table(), LIMITS, ROLES, AS_OF))


@_query("consistency_referential")
def _consistency_referential(t: Tables) -> DataFrame:
    return comparable(consistency.referential(t.dirty_table(), t.customers_ref(), LIMITS, ROLES))


@_query("orphan_rows")
def _orphan_rows(t: Tables) -> DataFrame:
    return comparable(consistency.orphan_rows(t.dirty_orders(), t.customers_ref(), "customer_id"))


@_query("consistency_arithmetic")
def _consistency_arithmetic(t: Tables) -> DataFrame:
    return comparable(consistency.arithmetic(t.dirty_table(), ROLES))


@_query("lineitem_arithmetic")
def _lineitem_arithmetic(t: Tables) -> DataFrame:
    rule = Arithmetic("price_per_unit", "l_extendedprice", ("l_quantity", "p_retailprice"), "l_quantity * p_retailprice")
    priced = t.read("lineitem").join(t.read("part"), F.expr("l_partkey = p_partkey"))
    return comparable(consistency.arithmetic(priced, Roles(arithmetic=(rule,))))


@_query("consistency_mapping")
def _consistency_mapping(t: Tables) -> DataFrame:
    return comparable(consistency.mapping(t.dirty_table(), t.city_state(), ROLES.lookup))


@_query("consistency_overall")
def _consistency_overall(t: Tables) -> DataFrame:
    return comparable(consistency.overall(t.dirty_table(), t.customers_ref(), t.city_state(), LIMITS, ROLES))


@_query("timeliness_freshness")
def _timeliness_freshness(t: Tables) -> DataFrame:
    return comparable(timeliness.freshness(t.dirty_table(), LIMITS, ROLES, AS_OF))


@_query("timeliness_recent")
def _timeliness_recent(t: Tables) -> DataFrame:
    return comparable(timeliness.recency(t.dirty_table(), LIMITS, ROLES, AS_OF))


@_query("timeliness_overall")
def _timeliness_overall(t: Tables) -> DataFrame:
    return comparable(timeliness.overall(t.dirty_table(), LIMITS, ROLES, AS_OF))


@_query("accuracy_distribution")
def _accuracy_distribution(t: Tables) -> DataFrame:
    return comparable(accuracy.distributions(t.dirty_table(), t.clean_table()))


@_query("accuracy_overall")
def _accuracy_overall(t: Tables) -> DataFrame:
    return comparable(accuracy.overall(t.dirty_table(), t.clean_table(), LIMITS))


@_query("custom_check")
def _custom_check(t: Tables) -> DataFrame:
    return comparable(custom.predicates(t.dirty_table(), RULES))


def _quality(t: Tables) -> DataFrame:
    return quality_checks(
        t.dirty_table(), "dirty_orders", t.customers_ref(), t.city_state(), t.clean_table(), LIMITS, ROLES, as_of=AS_OF
    )


@_query("quality_checks")
def _quality_report_checks(t: Tables) -> DataFrame:
    return comparable(_quality(t).select(*CHECK_COLUMNS))


@_query("quality_details")
def _quality_details(t: Tables) -> DataFrame:
    return detailed(_quality(t))


@_query("lookup_conflicts")
def _lookup_conflicts(t: Tables) -> DataFrame:
    return consistency.lookup_conflicts(t.dirty_orders().selectExpr("shipping_city AS key", "shipping_state AS value"))


@_query("checks_while_writing")
def _checks_while_writing(t: Tables) -> DataFrame:
    found = write_checked(t.dirty_table(), scratch(t.spark, "orders"), "dirty_orders", t.clean_table(), LIMITS, ROLES, as_of=AS_OF)
    return comparable(found.select(*CHECK_COLUMNS))


@_query("cumulative_duplicates")
def _cumulative_duplicates(t: Tables) -> DataFrame:
    store = SeenKeys(t.spark, f"seen_{uuid.uuid4().hex}", scratch(t.spark, "seen"), 16).attach()
    for first, last in ((1, 12), (13, 24), (25, 30)):
        store.absorb(t.dirty_orders().filter(f"day BETWEEN {first} AND {last}"), ["order_id"], "day")
    store.detach()
    return comparable(cumulative_duplicates(store.counts()))


@_query("quality_checks_incremental")
def _quality_checks_incremental(t: Tables) -> DataFrame:
    orders = t.dirty_orders()
    store = QualityStore(t.spark, scratch(t.spark, "quality"), f"quality_{uuid.uuid4().hex}", LIMITS, ROLES, as_of=AS_OF, buckets=16)
    for days in ("day <= 15", "day > 15"):
        store.absorb(orders.filter(days), t.customers_ref(), t.city_state())
    return comparable(store.quality_checks(orders, "dirty_orders", t.clean_table()).select(*CHECK_COLUMNS))


# Univariate anomalies


@_query("anomaly_iqr")
def _anomaly_iqr(t: Tables) -> DataFrame:
    return comparable(outliers.outliers(t.dirty_table(), "iqr"))


def _stored_sketches(t: Tables) -> DataFrame:
    """Sketches of all snapshots, stored as they would arrive: in two runs, the second of which repeats a snapshot."""
    path = scratch(t.spark, "sketches")
    for days in ("day <= 15", "day >= 15"):
        sketches.store(sketches.snapshot_sketches(t.dirty_orders().filter(days)), path)
    return sketches.load(t.spark, path)


@_query("anomaly_iqr_sketch")
def _anomaly_iqr_sketch(t: Tables) -> DataFrame:
    # A sketch's quartile differs from run to run; that it keeps its stated error does not.
    found = sketches.verified(t.dirty_table(), sketches.iqr_outliers(_stored_sketches(t)))
    within = [f"{c}_rank_off <= 2 * rank_error AS {c}_within" for c in ("q1", "q3")]
    return found.selectExpr("column", "values_checked", *within, "abs(outlier_rate - actual_rate) <= 4 * rank_error AS rate_within")


@_query("sketch_quantiles")
def _sketch_quantiles(t: Tables) -> DataFrame:
    kept = _stored_sketches(t).where("snapshot BETWEEN 11 AND 20")
    orders = t.dirty_orders().filter("day BETWEEN 11 AND 20")
    return comparable(sketches.quantile_rows(orders, kept, {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}))


@_query("anomaly_zscore")
def _anomaly_zscore(t: Tables) -> DataFrame:
    return comparable(outliers.outliers(t.dirty_table(), "zscore"))


@_query("anomaly_mad")
def _anomaly_mad(t: Tables) -> DataFrame:
    return comparable(outliers.outliers(t.dirty_table(), "modified_zscore"))


@_query("outlier_samples")
def _outlier_samples(t: Tables) -> DataFrame:
    orders = outliers.measured(t.dirty_table())
    return comparable(outliers.outlier_samples(orders, outliers.fit(orders, stored=True)))


@_query("outlier_rows")
def _outlier_rows(t: Tables) -> DataFrame:
    orders = t.dirty_orders()
    bounds = outliers.fit(orders.drop("day"))
    return outliers.outlier_rows(orders, bounds, ["order_id", "day"])


@_query("median_impute")
def _median_impute(t: Tables) -> DataFrame:
    numeric = ["quantity", "unit_price", "total_amount", "customer_age"]
    orders = kept(t.dirty_table(), ["order_id", *numeric], "orders")
    return comparable(outliers.median_impute(orders, numeric, stored=True))


@_query("event_value_outliers")
def _event_value_outliers(t: Tables) -> DataFrame:
    return comparable(outliers.outliers(t.read("events"), "iqr", ["value"]))


# Drift


def _metrics(t: Tables) -> DataFrame:
    return drift.snapshot_metrics(t.dirty_orders(), ROLES)


def _series(t: Tables) -> DataFrame:
    return drift.metric_series(_metrics(t))


@_query("daily_metrics")
def _daily_metrics(t: Tables) -> DataFrame:
    return comparable(_metrics(t))


@_query("category_entropy")
def _category_entropy(t: Tables) -> DataFrame:
    return comparable(drift.category_entropy(t.dirty_orders(), ROLES))


@_query("drift_events")
def _drift_events(t: Tables) -> DataFrame:
    return comparable(drift.drift_events(_series(t)), 4)


@_query("drift_summary")
def _drift_summary(t: Tables) -> DataFrame:
    return comparable(drift.drift_summary(_series(t)).selectExpr("* EXCEPT (alerts)", "size(alerts) AS alerts"))


@_query("drift_summary_alerts")
def _drift_summary_alerts(t: Tables) -> DataFrame:
    return comparable(drift.drift_summary(_series(t)).selectExpr("metric", "inline(alerts)"), 4)


@_query("drift_timeline")
def _drift_timeline(t: Tables) -> DataFrame:
    return comparable(drift.drift_timeline(_series(t)))


# Multivariate anomalies: no SQL counterpart


def _forest(t: Tables, *shown: str) -> tuple[DataFrame, forest.IsolationForestModel]:
    # what the forest and its query read of the orders, kept once: fit and transform scan it several times
    orders = t.dirty_table()
    orders = kept(orders, ["order_id", *shown, *numeric_columns(orders)], "orders")
    model = forest.fit(orders, key=["order_id"], stored=True)
    return model.transform(orders), model


@_query("isolation_forest")
def _isolation_forest(t: Tables) -> DataFrame:
    _, model = _forest(t)
    return comparable(forest.summary(model.fitted(), model))


@_query("isolation_top")
def _isolation_top(t: Tables) -> DataFrame:
    scored, model = _forest(t, "customer_id")
    return comparable(forest.most_anomalous(scored, ["order_id", "customer_id", *model.features[:5]]))


def _anomaly(t: Tables) -> DataFrame:
    # what the report and the metrics of its drift read of the orders, kept once: the joins run once for both
    orders = t.dirty_orders()
    orders = kept(drift.metric_inputs(orders, ROLES, numeric_columns(orders)), name="orders")
    series = drift.metric_series(drift.snapshot_metrics(orders, ROLES))
    return anomaly_checks(orders.drop("day"), "dirty_orders", series, with_forest=False, as_of=AS_OF, stored=True)


@_query("anomaly_checks")
def _anomaly_report_checks(t: Tables) -> DataFrame:
    return comparable(_anomaly(t).select(*CHECK_COLUMNS))


@_query("anomaly_details")
def _anomaly_details(t: Tables) -> DataFrame:
    return detailed(_anomaly(t).where("dimension <> 'anomaly_drift'"))


def sentinel_detector(df: DataFrame) -> DataFrame:
    """A detector as a user would add one: the share of quantities that stand for a missing one."""
    row = df.selectExpr("count(*) AS rows", "count_if(quantity = 999) AS found")
    rate = "CAST(found AS DOUBLE) / rows"
    return row.selectExpr(
        "'anomaly_sentinel' AS dimension", "'sentinel_quantity' AS check", "'quantity' AS column", f"{rate} <= 0.001D AS passed",
        f"greatest(0D, 1D - {rate} * 100) AS score", "0.001D AS threshold", "to_json(struct(rows, found)) AS details",
    )


@_query("custom_detector")
def _custom_detector(t: Tables) -> DataFrame:
    detector = {"detectors": [sentinel_detector], "detector_columns": ["quantity"]}
    found = anomaly_checks(t.dirty_table(), "dirty_orders", with_forest=False, as_of=AS_OF, **detector)
    return comparable(found.where("dimension = 'anomaly_sentinel'"))


# Scores and reports


@_query("dimension_scores")
def _dimension_scores(t: Tables) -> DataFrame:
    return comparable(scoring.dimension_scores(_quality(t)))


@_query("overall_score")
def _overall_score(t: Tables) -> DataFrame:
    return comparable(scoring.overall_score(scoring.dimension_scores(_quality(t)), LIMITS))


@_query("report_totals")
def _report_totals(t: Tables) -> DataFrame:
    return with_scores(scoring.report(_quality(t), LIMITS), QUALITY_DIMENSIONS)


@_query("dimension_status")
def _dimension_status(t: Tables) -> DataFrame:
    return comparable(scoring.dimension_status(_quality(t)))


@_query("merged_report")
def _merged_report(t: Tables) -> DataFrame:
    return with_scores(scoring.merged_report(_quality(t), _anomaly(t), LIMITS), QUALITY_DIMENSIONS + ANOMALY_DIMENSIONS)


@_query("merged_dimensions")
def _merged_dimensions(t: Tables) -> DataFrame:
    quality, anomaly = scoring.dimension_scores(_quality(t)), scoring.dimension_scores(_anomaly(t))
    return comparable(scoring.merged_dimension_scores(quality, anomaly))


@_query("check_totals")
def _check_totals(t: Tables) -> DataFrame:
    return scoring.check_totals(_quality(t))


@_query("failures_by_dimension")
def _failures_by_dimension(t: Tables) -> DataFrame:
    return scoring.failures_by_dimension(_quality(t))


# Profiles and catalog


@_query("profile_base")
def _profile_base(t: Tables) -> DataFrame:
    return comparable(profile.base_profile(t.dirty_table()))


@_query("profile_documents")
def _profile_documents(t: Tables) -> DataFrame:
    return comparable(profile.base_profile(t.labelled_documents()))


@_query("profile_numeric")
def _profile_numeric(t: Tables) -> DataFrame:
    return comparable(profile.numeric_profile(t.dirty_table()))


@_query("profile_moments")
def _profile_moments(t: Tables) -> DataFrame:
    return comparable(profile.moment_profile(t.dirty_table()), 4)


@_query("profile_top_values")
def _profile_top_values(t: Tables) -> DataFrame:
    return comparable(profile.top_values(t.dirty_table()))


@_query("frequent_values")
def _frequent_values(t: Tables) -> DataFrame:
    columns = ["product_category", "order_status", "payment_method", "shipping_city", "shipping_state", "order_id"]
    return comparable(profile.frequent_values(t.dirty_table(), columns).where("certain"))


@_query("profile_entropy")
def _profile_entropy(t: Tables) -> DataFrame:
    return profile.entropy_profile(t.dirty_table())


@_query("profile_datetime")
def _profile_datetime(t: Tables) -> DataFrame:
    parts = [
        profile.datetime_profile(t.read(name)).select(F.lit(name).alias("table_name"), "*")
        for name in ("orders", "events", "lineitem")
    ]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@_query("profile_flags")
def _profile_flags(t: Tables) -> DataFrame:
    return profile.quality_flags(t.dirty_table())


@_query("profile_samples")
def _profile_samples(t: Tables) -> DataFrame:
    return profile.samples(t.dirty_table())


@_query("table_profile")
def _table_profile(t: Tables) -> DataFrame:
    return profile.table_profile(t.dirty_table(), "dirty_orders")


@_query("table_size")
def _table_size(t: Tables) -> DataFrame:
    return profile.table_size(t.dirty_table(), "dirty_orders")


def _tables(t: Tables) -> dict[str, DataFrame | None]:
    return {
        "orders": t.dirty_table(),
        "customers": t.customers_ref(),
        "ground_truth": t.clean_table(),
        "returns": None,
    }


@_query("catalog")
def _catalog(t: Tables) -> DataFrame:
    return catalogs.catalog(_tables(t))


@_query("catalog_columns")
def _catalog_columns(t: Tables) -> DataFrame:
    return comparable(catalogs.catalog_columns(_tables(t)))


@_query("cross_table")
def _cross_table(t: Tables) -> DataFrame:
    return comparable(catalogs.cross_table(t.dirty_orders(), t.clean_table()))


@_query("null_rate_compare")
def _null_rate_compare(t: Tables) -> DataFrame:
    return comparable(completeness.null_rate_comparison(t.dirty_table(), t.clean_table()))


# History and alerts


def score_history(t: Tables) -> DataFrame:
    """One report row per snapshot: its completeness over the drift columns, dated by the snapshot."""
    rates = [f"null_rate_{c}" for c in ROLES.drift_nulls]
    limits = [LIMITS.max_null_rate[c] for c in ROLES.drift_nulls]
    passed = " + ".join(f"CASE WHEN {r} <= {x}D THEN 1L ELSE 0L END" for r, x in zip(rates, limits, strict=True))
    scored = _metrics(t).selectExpr(
        "TIMESTAMP '2026-01-01 00:00:00' + make_dt_interval(CAST(snapshot - 1 AS INT)) AS ts",
        f"1D - ({' + '.join(rates)}) / {len(rates)} AS overall_score",
        f"{passed} AS num_passed",
    )
    return scored.selectExpr(
        "ts",
        "overall_score",
        f"{scoring.status_of('overall_score', LIMITS.with_(critical=0.75, warning=0.85))} AS status",
        "map('completeness', overall_score) AS dimension_scores",
        f"{len(rates)}L AS num_checks",
        "num_passed",
        f"{len(rates)}L - num_passed AS num_failed",
        "'full' AS run_type",
        "to_date(ts) AS run_date",
    )


@_query("history_load")
def _history_load(t: Tables) -> DataFrame:
    loaded = history.recent(score_history(t), AS_OF, days=30, limit=20)
    return with_scores(loaded, ("completeness",))


@_query("history_load_oldest")
def _history_load_oldest(t: Tables) -> DataFrame:
    loaded = history.recent(score_history(t), AS_OF, days=30, limit=20, oldest=True)
    return comparable(loaded.select("ts", "overall_score", "status"))


@_query("history_latest")
def _history_latest(t: Tables) -> DataFrame:
    return with_scores(history.latest(score_history(t)), ("completeness",))


@_query("history_trend")
def _history_trend(t: Tables) -> DataFrame:
    return history.trend(history.recent(score_history(t), AS_OF))


@_query("history_series")
def _history_series(t: Tables) -> DataFrame:
    return comparable(history.series(history.recent(score_history(t), AS_OF)))


@_query("alert_rules")
def _alert_rules(t: Tables) -> DataFrame:
    report = scoring.report(_quality(t), LIMITS)
    rules, limits = {"any_failures": True}, LIMITS.with_(critical=0.99)
    return comparable(alerts.alerts(report, drift.drift_events(_series(t)), rules, limits))


@_query("alert_daily_summary")
def _alert_daily_summary(t: Tables) -> DataFrame:
    report = scoring.report(_quality(t), LIMITS)
    return comparable(alerts.alerts(report, None, {}, LIMITS.with_(critical=0.0)))


# Report queries


@_query("quality_timeline")
def _quality_timeline(t: Tables) -> DataFrame:
    return comparable(reports.quality_timeline(t.dirty_orders(), ROLES, AS_OF))


@_query("category_share")
def _category_share(t: Tables) -> DataFrame:
    return comparable(reports.category_share(t.dirty_orders(), roles=ROLES))


@_query("category_shares")
def _category_shares(t: Tables) -> DataFrame:
    return comparable(reports.category_shares(t.dirty_orders(), Roles(category="product_name")))


@_query("preview")
def _preview(t: Tables) -> DataFrame:
    return reports.preview(t.dirty_orders().select("order_id", "customer_email", "day"), 12, ["customer_email", "order_id", "day"])


@_query("histogram")
def _histogram(t: Tables) -> DataFrame:
    return comparable(reports.histogram(t.dirty_table(), "total_amount"))


@_query("event_histogram")
def _event_histogram(t: Tables) -> DataFrame:
    return comparable(reports.histogram(t.read("events"), "value"))


@_query("top_values")
def _top_values(t: Tables) -> DataFrame:
    return reports.top_values(t.dirty_table(), "product_name")


@_query("kpis")
def _kpis(t: Tables) -> DataFrame:
    return comparable(reports.kpis(t.dirty_table(), t.clean_table(), t.customers_ref(), _quality(t)), 2)


@_query("missing_share")
def _missing_share(t: Tables) -> DataFrame:
    selected = ["customer_email", "unit_price", "shipping_city", "customer_age"]
    return comparable(completeness.missing_share(t.dirty_table(), selected))


@_query("outliers_by_column")
def _outliers_by_column(t: Tables) -> DataFrame:
    return comparable(reports.outliers_by_column(t.dirty_table()))


@_query("filter_domains")
def _filter_domains(t: Tables) -> DataFrame:
    return reports.filter_domains(t.dirty_table(), ["product_category", "order_status"], ROLES)


@_query("filtered_orders")
def _filtered_orders(t: Tables) -> DataFrame:
    kept = reports.filtered(
        t.dirty_table(), "2026-01-05", "2026-01-20", {"product_category": ["BUILDING", "MACHINERY"]}, ROLES
    )
    return comparable(kept)


@_query("event_day")
def _event_day(t: Tables) -> DataFrame:
    return comparable(
        reports.with_event_day(t.dirty_table(), ROLES).select("order_id", "order_date", "order_date_parsed", "day_of_month")
    )


# Windows: the batch form of the streaming metrics


@_query("windowed_metrics")
def _windowed_metrics_daily(t: Tables) -> DataFrame:
    return comparable(windowed_metrics(t.read("events"), "ts", "value", (0.0, 100.0), "1 day", nulls_of=["user_id"]))


@_query("windowed_drift")
def _windowed_drift(t: Tables) -> DataFrame:
    windows = windowed_metrics(t.read("events"), "ts", "value", (0.0, 100.0), "1 day")
    series = drift.metric_series(windows.withColumnRenamed("window_start", "snapshot"))
    return comparable(drift.drift_events(series), 4)
