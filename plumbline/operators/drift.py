"""Quality metrics per snapshot and their drift against the preceding snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import EPSILON, Roles
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import has, nan_to_null, numeric_columns
from plumbline.functions.lineage import kept

# Window length, alert limit, accepted share of alerts, timeline points listed.
WINDOW = 5
SIGMA = 2.0
MAX_RATE = 0.05
TIMELINE_POINTS = 10


def _by_category(df: DataFrame, roles: Roles, sums: dict[str, str]) -> DataFrame:
    """Sums per (snapshot, category), from which all snapshot metrics are derived."""
    groups = df.groupBy(
        F.expr(f"{sql.name(roles.snapshot)} AS snapshot"), F.expr(f"{sql.name(roles.category)} AS category")
    )
    return groups.agg(*[F.expr(sql.alias(expression, name)) for name, expression in sums.items()])


def _entropy(groups: DataFrame) -> DataFrame:
    """Shannon entropy of the non-null categories per snapshot.

    Totals are joined back rather than taken by a window, so a snapshot's categories never have to meet in one task.
    """
    present = groups.filter("category IS NOT NULL").select("snapshot", "category", "rows")
    totals = present.groupBy("snapshot").agg(F.expr("sum(rows) AS total"), F.expr("count(*) AS categories"))
    return (
        present.join(totals, "snapshot")
        .groupBy("snapshot")
        .agg(
            F.expr("max(total) AS values"),
            F.expr("max(categories) AS categories"),
            F.expr(f"sum({sql.entropy_term('(rows / total)')}) AS category_entropy"),
        )
    )


def category_entropy(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return _entropy(_by_category(nan_to_null(df), roles, {"rows": "count(*)"}))


def metric_inputs(df: DataFrame, roles: Roles = Roles(), others: Sequence[str] = ()) -> DataFrame:
    """What ``snapshot_metrics`` reads of ``df``, and the columns ``others``, to be kept once for both.

    A column of which only the nulls are counted is true or null.
    """
    whole = {roles.snapshot, roles.category, roles.amount, *roles.sentinels, *others}
    # a number may be NaN, which is missing too
    nulls = set(roles.drift_nulls) - whole - set(numeric_columns(df))
    named = [c for c in df.columns if c in whole or c in roles.drift_nulls]
    return df.selectExpr(*[sql.alias(f"CASE WHEN {sql.name(c)} IS NOT NULL THEN true END", c) if c in nulls else sql.name(c) for c in named])


def snapshot_metrics(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per snapshot: null rates, sentinel rates, category entropy, row count, mean amount.

    A null never equals a sentinel but counts in the denominator.
    """
    df = nan_to_null(df)
    nulls = [c for c in roles.drift_nulls if has(df, c)]
    sentinels = {c: v for c, v in roles.sentinels.items() if has(df, c)}
    sums = {"rows": "count(*)"}
    sums |= {f"nulls of {c}": sql.tally(f"{sql.name(c)} IS NULL") for c in nulls}
    sums |= {f"sentinels in {c}": sql.tally(f"{sql.as_double(c)} = {sql.double(v)}") for c, v in sentinels.items()}
    out = {f"null_rate_{c}": sql.rate(sql.name(f"nulls of {c}"), "rows") for c in nulls}
    out |= {f"outlier_{c}_{v}": sql.rate(sql.name(f"sentinels in {c}"), "rows") for c, v in sentinels.items()}
    out |= {"category_entropy": "category_entropy", "order_count": "rows"}
    if has(df, roles.amount):
        sums |= {"amount": f"sum({sql.as_double(roles.amount)})", "amounts": f"count({sql.name(roles.amount)})"}
        out["avg_order_value"] = "try_divide(amount, amounts)"
    # a row per snapshot and category, read for the totals and for the entropy
    groups = kept(_by_category(df, roles, sums), name="groups")
    totals = groups.groupBy("snapshot").agg(*[F.expr(sql.alias(f"sum({sql.name(c)})", c)) for c in sums])
    joined = totals.join(_entropy(groups).select("snapshot", "category_entropy"), "snapshot", "left")
    return joined.selectExpr("snapshot", *[sql.alias(expression, name) for name, expression in out.items()])


def metric_series(metrics: DataFrame) -> DataFrame:
    """Long form (metric, snapshot, value) of a frame with one row per snapshot."""
    names = [c for c in metrics.columns if c != "snapshot"]
    doubles = metrics.selectExpr("snapshot", *[sql.alias(sql.as_double(c), c) for c in names])
    return doubles.unpivot(["snapshot"], [sql.name(c) for c in names], "metric", "value")


def _scored(series: DataFrame, window: int, sigma: float) -> DataFrame:
    """Each point with mean and population deviation of the ``window`` preceding snapshots, and whether it is an alert.

    The windows run over one row per snapshot and metric. A missing value inside the frame leaves z null.
    """
    by_metric = "PARTITION BY metric ORDER BY snapshot"
    trailing = f"OVER ({by_metric} ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)"
    complete = f"count(value) {trailing} = {window}"
    points = series.selectExpr(
        "*",
        f"row_number() OVER ({by_metric}) AS position",
        f"CASE WHEN {complete} THEN avg(value) {trailing} END AS rolling_mean",
        f"CASE WHEN {complete} THEN greatest(stddev_pop(value) {trailing}, {sql.double(EPSILON)}) END AS rolling_std",
        "count(*) OVER (PARTITION BY metric) AS snapshots",
    )
    scored = points.selectExpr("*", "(value - rolling_mean) / rolling_std AS z_score")
    return scored.selectExpr("*", f"coalesce(position > {window} AND abs(z_score) > {sql.double(sigma)}, false) AS alert")


def drift_events(series: DataFrame, window: int = WINDOW, sigma: float = SIGMA) -> DataFrame:
    """Points more than ``sigma`` deviations away from the preceding snapshots."""
    events = _scored(series, window, sigma).filter("alert")
    return events.select("metric", "snapshot", "value", "rolling_mean", "rolling_std", "z_score")


def drift_summary(series: DataFrame, window: int = WINDOW, sigma: float = SIGMA) -> DataFrame:
    """Events per metric over the snapshots that have a full window; metrics with too few snapshots are left out.

    All alerts are listed: at most one per snapshot and metric.
    """
    listed = "collect_list(CASE WHEN alert THEN struct(snapshot, value, rolling_mean, z_score) END)"
    per_metric = (
        _scored(series, window, sigma)
        .groupBy("metric")
        .agg(
            F.expr("max(snapshots) AS snapshots"),
            F.expr("count_if(alert) AS drift_events"),
            F.expr(f"array_sort({listed}) AS alerts"),
        )
    )
    rated = per_metric.filter(f"snapshots > {window}").selectExpr(
        "*", f"CAST(drift_events AS DOUBLE) / (snapshots - {window}) AS drift_rate"
    )
    return rated.selectExpr(
        "metric",
        "snapshots",
        "drift_events",
        "drift_rate",
        f"drift_rate <= {sql.double(MAX_RATE)} AS passed",
        "greatest(0D, 1D - drift_rate * 10) AS score",
        f"{sql.double(MAX_RATE)} AS threshold",
        "alerts",
    )


def drift_timeline(series: DataFrame, points: int = TIMELINE_POINTS) -> DataFrame:
    """Every n-th point of each metric, so that about ``points`` remain."""
    placed = series.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY metric ORDER BY snapshot) AS position",
        "count(*) OVER (PARTITION BY metric) AS snapshots",
    )
    kept = placed.filter(f"(position - 1) % greatest(1, snapshots DIV {int(points)}) = 0")
    return kept.select("metric", "snapshot", "value")


def check_rows(series: DataFrame, window: int = WINDOW, sigma: float = SIGMA) -> DataFrame:
    """The drift summary in the common check schema."""
    return drift_summary(series, window, sigma).selectExpr(
        "'anomaly_drift' AS dimension",
        "concat('drift_', metric) AS check",
        f"{sql.string(None)} AS column",
        "passed",
        "score",
        "threshold",
        "to_json(struct(metric, snapshots, drift_events, drift_rate, alerts)) AS details",
        "score AS basis",
    )
