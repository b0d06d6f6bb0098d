"""Report queries: timelines, shares, histograms, key figures and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import Roles
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import as_timestamp, has, nan_to_null, numeric_columns
from plumbline.operators import checks as fused
from plumbline.operators import outliers as univariate

MAX_BINS = 50
MAX_CATEGORIES = 1000
# Names of the timeline's shares, and the column and bounds of plausible ages.
TIMELINE_NAMES = {
    "null_customer_email": "null_email", "null_unit_price": "null_price", "null_customer_age": "null_age",
    "outlier_quantity": "outlier_qty", "outlier_unit_price": "outlier_price",
}
AGE = ("customer_age", 0, 120)


def quality_timeline(df: DataFrame, roles: Roles = Roles(), as_of=None) -> DataFrame:
    """Quality metrics per snapshot.

    Rows are summed per (snapshot, key) first, which yields the duplicates too: one shuffle of the table. Shares of
    columns that the table lacks are left out.
    """
    df = nan_to_null(df)
    shares = {TIMELINE_NAMES.get(f"null_{c}", f"null_{c}"): f"{sql.name(c)} IS NULL" for c in roles.drift_nulls if has(df, c)}
    if has(df, roles.event_time):
        event = as_timestamp(df, roles.event_time, roles.time_formats)
        shares["future_date_rate"] = f"{event} > {sql.timestamp(as_of)}"
    for c, sentinel in roles.sentinels.items():
        if has(df, c):
            shares[TIMELINE_NAMES.get(f"outlier_{c}", f"outlier_{c}")] = f"{sql.as_double(c)} = {sql.double(sentinel)}"
    if has(df, AGE[0]):
        age = sql.as_double(AGE[0])
        shares["invalid_age"] = f"{age} < {AGE[1]} OR {age} > {AGE[2]}"
    amount = {"amount": "CAST(NULL AS DOUBLE)", "amounts": "0L"}
    if has(df, roles.amount):
        amount = {"amount": f"sum({sql.as_double(roles.amount)})", "amounts": f"count({sql.name(roles.amount)})"}
    per_key = df.groupBy(
        F.expr(f"{sql.name(roles.snapshot)} AS snapshot"), F.expr(f"{sql.name(roles.keys[0])} AS _key")
    ).agg(
        F.expr("count(*) AS rows"),
        *[F.expr(sql.alias(expression, name)) for name, expression in amount.items()],
        *[F.expr(sql.alias(sql.tally(condition), name)) for name, condition in shares.items()],
    )
    totals = per_key.groupBy("snapshot").agg(
        F.expr("sum(rows) AS order_count"),
        F.expr("sum(rows - 1) AS repeated"),
        *[F.expr(f"sum({c}) AS {c}") for c in ("amount", "amounts", *shares)],
    )
    return totals.selectExpr(
        "snapshot",
        "order_count",
        f"{sql.rate('repeated', 'order_count')} AS duplicate_rate",
        "try_divide(amount, amounts) AS avg_order_value",
        *[sql.alias(sql.rate(name, "order_count"), name) for name in shares],
    )


def category_share(df: DataFrame, categories: Sequence[str] | None = None, roles: Roles = Roles()) -> DataFrame:
    """Share of each category among the non-null ones per snapshot, one column per category.

    Without a list all categories of the table are found first; more than ``MAX_CATEGORIES`` are an error, as they cannot
    be columns.
    """
    category = sql.name(roles.category)
    if categories is None:
        found = df.selectExpr(f"CAST({category} AS STRING) AS value").dropna().distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"column {roles.category!r} has more than {MAX_CATEGORIES} categories")
        categories = sorted(r["value"] for r in found)
    counted = df.groupBy(F.expr(f"{sql.name(roles.snapshot)} AS snapshot")).agg(
        F.expr(f"count({category}) AS _values"),
        *[F.expr(sql.alias(sql.tally(f"{category} = {sql.string(v)}"), f"count of {v}")) for v in categories],
    )
    return counted.selectExpr(
        "snapshot", *[sql.alias(sql.rate(sql.name(f"count of {v}"), "_values"), v) for v in categories]
    )


def _first_distinct(limit: int):
    """At most ``limit`` distinct values of each task: enough to tell how many there are up to the limit."""

    def values(batches):
        import pyarrow as pa

        seen: set[float] = set()
        for batch in batches:
            if len(seen) < limit:
                new = [v for v in batch.column(0).unique().to_pylist() if v not in seen][: limit - len(seen)]
                seen.update(new)
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.float64())], names=["value"])

    return values


def histogram(df: DataFrame, column: str, max_bins: int = MAX_BINS) -> DataFrame:
    """Equal-width bins over the range of finite values, as many as there are distinct ones but at most ``max_bins``.

    Infinite values are counted in rows without a bin, whose start and end they are.
    """
    present = nan_to_null(df, [column]).selectExpr(f"{sql.as_double(column)} AS value").dropna()
    finite = "abs(value) < DOUBLE('Infinity')"
    values = present.filter(finite)
    infinite = present.filter(f"NOT {finite}").groupBy("value").agg(F.expr("count(*) AS count"))
    few = values.mapInArrow(_first_distinct(int(max_bins)), "value double").distinct().selectExpr(f"least(count(*), {int(max_bins)}L)")
    ends = values.selectExpr("min(value) AS low", "max(value) AS high").withColumn("bins", few.scalar())
    span = ends.selectExpr("struct(low, high, bins) AS span")
    placed = values.withColumn("span", span.scalar()).selectExpr("value", "span.low", "span.high", "span.bins")
    step = "CAST(floor(bins * (value - low) / (high - low)) AS BIGINT) + 1"
    index = f"CASE WHEN high > low THEN least({step}, bins) ELSE 1L END AS bin"
    return (
        placed.selectExpr(index, "low", "high", "bins")
        .groupBy("bin", "low", "high", "bins")
        .agg(F.expr("count(*) AS count"))
        .selectExpr(
            "bin",
            "low + (high - low) * (bin - 1) / bins AS bin_start",
            "low + (high - low) * bin / bins AS bin_end",
            "count",
        )
        .unionByName(infinite.selectExpr("CAST(NULL AS BIGINT) AS bin", "value AS bin_start", "value AS bin_end", "count"))
    )


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values, ties by value; only k rows per task reach the final merge."""
    values = df.selectExpr(f"{sql.name(column)} AS value").dropna()
    return values.groupBy("value").agg(F.expr("count(*) AS count")).orderBy(F.desc("count"), "value").limit(k)


def kpis(
    df: DataFrame, truth: DataFrame, customers: DataFrame, checks: DataFrame, amount: str = Roles().amount
) -> DataFrame:
    """Headline figures in one row; the other tables contribute aggregated scalars."""
    totals = nan_to_null(df).selectExpr("count(*) AS orders", f"sum({sql.as_double(amount)}) AS total_revenue")
    passing = checks.selectExpr("struct(count(*) AS checks, count_if(passed) AS passed) AS passing")
    gathered = totals.withColumns(
        {
            "truth_rows": truth.selectExpr("count(*)").scalar(),
            "customers": customers.selectExpr("count(*)").scalar(),
            "passing": passing.scalar(),
        }
    )
    return gathered.selectExpr(
        "orders",
        "orders - truth_rows AS orders_delta",
        "customers",
        "total_revenue",
        "passing.checks AS num_checks",
        "passing.passed AS num_passed",
        f"{sql.rate('passing.passed', 'passing.checks')} * 100 AS passed_pct",
    )


def filter_domains(df: DataFrame, columns: Sequence[str], roles: Roles = Roles()) -> DataFrame:
    """What a filter may offer: first and last date of the event time, distinct values of the given columns."""
    day = f"to_date({as_timestamp(df, roles.event_time, roles.time_formats)})"
    span = df.selectExpr(f"CAST(min({day}) AS STRING) AS low", f"CAST(max({day}) AS STRING) AS high")
    bounds = span.selectExpr(
        sql.inline(
            [
                sql.struct({"domain": "'min_date'", "value": "low"}),
                sql.struct({"domain": "'max_date'", "value": "high"}),
            ]
        )
    ).dropna()
    cells = df.selectExpr(*[sql.alias(f"CAST({sql.name(c)} AS STRING)", c) for c in columns])
    values = cells.unpivot([], [sql.name(c) for c in columns], "domain", "value").dropna().distinct()
    return bounds.unionByName(values)


def filtered(
    df: DataFrame, first: str, last: str, members: Mapping[str, Sequence[str]], roles: Roles = Roles()
) -> DataFrame:
    """Rows dated first…last (inclusive days) whose columns hold one of the listed members."""
    day = f"to_date({as_timestamp(df, roles.event_time, roles.time_formats)})"
    kept = df.filter(f"{day} BETWEEN DATE {sql.string(first)} AND DATE {sql.string(last)}")
    for column, allowed in members.items():
        if allowed:
            kept = kept.filter(f"{sql.name(column)} IN ({', '.join(sql.string(v) for v in allowed)})")
    return kept


def with_event_day(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Add the parsed event time and its day of the month."""
    parsed = as_timestamp(df, roles.event_time, roles.time_formats)
    return df.selectExpr(
        "*", sql.alias(parsed, f"{roles.event_time}_parsed"), f"dayofmonth({parsed}) AS day_of_month"
    )


def outliers_by_column(df: DataFrame, methods: Sequence[str] = univariate.METHODS) -> DataFrame:
    """Outlier counts of every column under every method; all are counted in one scan."""
    df = nan_to_null(df)
    df = univariate.measured(df) if numeric_columns(df) else df
    wanted = ("column", "method", "outlier_count", "outlier_rate")
    bounds, some = univariate.or_none(df, univariate.fit(df, methods=methods, stored=True), None, methods)
    checks = [replace(check, fields={name: check.fields[name] for name in wanted}) for check in univariate.outlier_checks(bounds)]
    found = fused.flat(df, checks).drop("score", "threshold")
    return found if some else found.limit(0)


def preview(df: DataFrame, rows: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows, in the order of some columns (nulls first) if these are given: each task keeps that many."""
    ordered = df.orderBy(*[F.col(sql.name(c)).asc_nulls_first() for c in order_by]) if order_by else df
    return ordered.limit(rows)


def category_shares(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """``category_share`` in rows, for any number of categories: snapshot, category, rows, share of the non-null ones.

    Categories are counted in tasks first; a snapshot's total is joined to them, so they never meet in one task.
    """
    counted = df.groupBy(F.expr(f"{sql.name(roles.snapshot)} AS snapshot"), F.expr(f"CAST({sql.name(roles.category)} AS STRING) AS category"))
    counts = counted.agg(F.expr("count(*) AS rows")).where("category IS NOT NULL")
    totals = counts.groupBy("snapshot").agg(F.expr("sum(rows) AS total"))
    return counts.join(totals, "snapshot").selectExpr("snapshot", "category", "rows", "CAST(rows AS DOUBLE) / total AS share")
