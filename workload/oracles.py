"""SQL counterparts of the registered queries, written independently for DuckDB over the same Parquet tables."""

from __future__ import annotations

from workload.fixture import AS_OF, CATEGORIES, ORDER_COLUMNS

TABLE_COLUMNS = [c for c in ORDER_COLUMNS if c != "day"]
CLEAN = TABLE_COLUMNS
NUMERIC = ["quantity", "unit_price", "total_amount", "customer_age"]
STRINGS = [c for c in TABLE_COLUMNS if c not in NUMERIC]
NOW = f"TIMESTAMP '{AS_OF}'"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

FIXTURE = """
WITH base AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_linenumber AS ln, o.o_custkey AS ck,
         c.c_name, c.c_mktsegment, n.n_name, r.r_name, p.p_name, p.p_retailprice,
         o.o_orderstatus, o.o_orderpriority,
         1 + l.l_orderkey % 30 AS day,
         1 + l.l_partkey % 10 AS qty,
         (l.l_orderkey * 7919 + l.l_partkey * 104729 + l.l_linenumber * 31) % 1000 AS h1,
         (l.l_orderkey * 6101 + l.l_partkey * 1299709 + l.l_suppkey * 17) % 1000 AS h2,
         (l.l_orderkey * 3571 + l.l_partkey * 15485863 + l.l_suppkey * 101) % 1000 AS h3
  FROM lineitem l
  JOIN orders   o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation   n ON c.c_nationkey = n.n_nationkey
  JOIN region   r ON n.n_regionkey = r.r_regionkey
  JOIN part     p ON l.l_partkey = p.p_partkey
),
dirty_once AS (
  SELECT
    'ORD' || CAST(ok AS STRING) || '-' || CAST(ln AS STRING) AS order_id,
    CASE WHEN h3 < 20 + day THEN 'ORPHAN' || CAST(ck AS STRING)
         ELSE 'CUST' || CAST(ck AS STRING) END AS customer_id,
    c_name AS customer_name,
    CASE WHEN h1 < 120 + 4 * day THEN NULL
         WHEN h1 >= 980 THEN ''
         WHEN h2 < 50 + 2 * day THEN 'user' || CAST(ck AS STRING) || '@domain'
         ELSE 'user' || CAST(ck AS STRING) || '@email.com' END AS customer_email,
    CASE WHEN h2 >= 990 - day THEN 'MACHINERY' ELSE c_mktsegment END AS product_category,
    p_name AS product_name,
    CASE WHEN h3 >= 995 THEN CAST(999 AS BIGINT) ELSE qty END AS quantity,
    CASE WHEN h2 >= 920 - 3 * day THEN NULL
         WHEN h3 >= 992 AND h3 < 995 THEN CAST(999999 AS DOUBLE)
         ELSE p_retailprice END AS unit_price,
    qty * p_retailprice AS total_amount,
    CASE WHEN h1 >= 960 AND h1 < 970 THEN '2027-06-15 12:00:00'
         WHEN h1 >= 970 AND h1 < 975 THEN 'not-a-date'
         ELSE '2026-01-' || lpad(CAST(day AS STRING), 2, '0') || ' '
              || lpad(CAST(pk % 24 AS STRING), 2, '0') || ':00:00' END AS order_date,
    o_orderstatus AS order_status,
    CASE WHEN h3 >= 960 AND h3 < 980 THEN NULL ELSE o_orderpriority END AS payment_method,
    CASE WHEN h2 >= 400 AND h2 < 450 THEN NULL ELSE n_name END AS shipping_city,
    CASE WHEN h2 >= 450 AND h2 < 455 THEN 'ATLANTIS' ELSE r_name END AS shipping_state,
    CASE WHEN h3 >= 500 AND h3 < 530 THEN NULL
         WHEN h3 >= 530 AND h3 < 535 THEN CAST(-1 AS BIGINT)
         WHEN h3 >= 535 AND h3 < 540 THEN CAST(999 AS BIGINT)
         ELSE 18 + ck % 58 END AS customer_age,
    day, h1
  FROM base
),
dirty_orders AS (
  SELECT * EXCLUDE (h1) FROM dirty_once
  UNION ALL
  SELECT * EXCLUDE (h1) FROM dirty_once WHERE h1 < 30 + 2 * day
),
clean_orders AS (
  SELECT 'ORD' || CAST(ok AS STRING) || '-' || CAST(ln AS STRING) AS order_id,
         'CUST' || CAST(ck AS STRING) AS customer_id, c_name AS customer_name,
         'user' || CAST(ck AS STRING) || '@email.com' AS customer_email,
         c_mktsegment AS product_category, p_name AS product_name, qty AS quantity,
         p_retailprice AS unit_price, qty * p_retailprice AS total_amount,
         '2026-01-' || lpad(CAST(day AS STRING), 2, '0') || ' '
           || lpad(CAST(pk % 24 AS STRING), 2, '0') || ':00:00' AS order_date,
         o_orderstatus AS order_status, o_orderpriority AS payment_method,
         n_name AS shipping_city, r_name AS shipping_state, 18 + ck % 58 AS customer_age, day
  FROM base
),
customers_ref AS (
  SELECT 'CUST' || CAST(c_custkey AS STRING) AS customer_id, c_name AS customer_name FROM customer
),
city_state AS (
  SELECT n_name AS city, r_name AS state FROM nation JOIN region ON n_regionkey = r_regionkey
),
o AS (SELECT * EXCLUDE (day), TRY_CAST(order_date AS TIMESTAMP) AS od FROM dirty_orders)
"""


def _sql(body: str, *ctes: str) -> str:
    """The fixture, then named CTEs, then the query."""
    return FIXTURE + "".join(f",\n{cte}" for cte in ctes) + "\n" + body


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Quality checks: one CTE per check family, each with its reported columns.

_LIMIT = {
    "customer_email": 0.15, "unit_price": 0.10, "shipping_city": 0.08, "customer_age": 0.05, "payment_method": 0.05,
}


def _null_rate(c: str) -> str:
    empties = f"count(*) FILTER ({c} = '')" if c in STRINGS else "0"
    return (
        f"SELECT '{c}' AS \"column\", count(*) AS total_rows, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"{empties} AS empty_string_count, {_LIMIT.get(c, 0.10)}::DOUBLE AS threshold FROM o"
    )


NULL_RATES = (
    "null_counts AS (" + _union([_null_rate(c) for c in TABLE_COLUMNS]) + "),\n"
    'null_rates AS (SELECT "column", total_rows, null_count, empty_string_count::BIGINT AS empty_string_count, '
    "(null_count + empty_string_count)::BIGINT AS total_missing, "
    "(null_count + empty_string_count)::DOUBLE / total_rows AS null_rate, threshold, "
    "(null_count + empty_string_count)::DOUBLE / total_rows <= threshold AS passed, "
    "greatest(0, 1 - (null_count + empty_string_count)::DOUBLE / total_rows / threshold)::DOUBLE AS score "
    "FROM null_counts)"
)
EXACT = (
    f"exact_groups AS (SELECT count(*) AS c FROM o GROUP BY {', '.join(TABLE_COLUMNS)}),\n"
    "exact_dups AS (SELECT sum(c)::BIGINT AS total_rows, sum(c - 1)::BIGINT AS duplicate_rows, "
    "sum(c - 1)::DOUBLE / sum(c)::DOUBLE AS duplicate_rate FROM exact_groups)"
)
KEYS = (
    "key_groups AS (SELECT order_id, count(*) AS c FROM o GROUP BY order_id),\n"
    "key_dups AS (SELECT 'order_id' AS key_column, sum(c)::BIGINT AS total_rows, sum(c - 1)::BIGINT AS duplicate_keys, "
    "sum(c - 1)::DOUBLE / sum(c)::DOUBLE AS duplicate_rate FROM key_groups)"
)
DUP_RESULT = (
    "round(duplicate_rate, 6) AS duplicate_rate, duplicate_rate <= 0.03 AS passed, "
    "round(greatest(0, 1 - duplicate_rate / 0.03), 6)::DOUBLE AS score, 0.03::DOUBLE AS threshold"
)
FORMAT = (
    "format_counts AS (SELECT count(customer_email) AS values_checked, "
    f"count(*) FILTER (regexp_matches(customer_email, '{EMAIL}')) AS valid FROM o),\n"
    "format_check AS (SELECT *, valid::DOUBLE / values_checked AS validity_rate FROM format_counts)"
)
FUTURE = (
    f"date_counts AS (SELECT count(*) AS total_rows, count(*) FILTER (od > {NOW}) AS future_dates, "
    "count(*) FILTER (od IS NULL) AS parse_failures FROM o),\n"
    "future_check AS (SELECT *, future_dates::DOUBLE / total_rows AS future_date_rate, "
    "1 - parse_failures::DOUBLE / total_rows AS parse_success_rate FROM date_counts)"
)


def _range(c: str, low: int, high: int) -> str:
    return (
        f"SELECT '{c}' AS \"column\", {low}::DOUBLE AS range_min, {high}::DOUBLE AS range_max, "
        f"count({c}) AS values_checked, count(*) FILTER ({c} < {low} OR {c} > {high}) AS out_of_range, "
        f"min({c})::DOUBLE AS actual_min, max({c})::DOUBLE AS actual_max FROM o"
    )


RANGE = (
    "range_counts AS ("
    + _union([_range("quantity", 1, 10), _range("unit_price", 0, 500000), _range("customer_age", 0, 120)])
    + "),\nrange_check AS (SELECT *, out_of_range::DOUBLE / values_checked AS out_of_range_rate FROM range_counts)"
)
REFERENCE = (
    "orphan_counts AS (SELECT count(*) AS total_rows, count(*) FILTER (customer_id IS NULL OR customer_id NOT IN "
    "(SELECT customer_id FROM customers_ref)) AS orphan_records FROM o),\n"
    "reference_check AS (SELECT *, orphan_records::DOUBLE / total_rows AS orphan_rate, "
    "1 - orphan_records::DOUBLE / total_rows AS valid_rate FROM orphan_counts)"
)
ARITHMETIC = (
    "complete AS (SELECT total_amount AS a, quantity * unit_price AS e FROM o "
    "WHERE quantity IS NOT NULL AND unit_price IS NOT NULL AND total_amount IS NOT NULL),\n"
    "arithmetic_check AS (SELECT count(*) AS rows_checked, "
    "count(*) FILTER (abs(a - e) / CASE WHEN e = 0 THEN 1 ELSE abs(e) END > 0.005) AS bad, "
    "count(*) FILTER (abs(a - e) / CASE WHEN e = 0 THEN 1 ELSE abs(e) END > 0.005)::DOUBLE / count(*) AS rate FROM complete)"
)
MAPPING = (
    "mapping_check AS (SELECT count(*) AS rows_checked, count(*) FILTER (state <> shipping_state) AS bad, "
    "count(*) FILTER (state <> shipping_state)::DOUBLE / count(*) AS rate "
    "FROM o LEFT JOIN city_state ON shipping_city = city WHERE shipping_city IS NOT NULL AND shipping_state IS NOT NULL)"
)
TIMELY = (
    f"timely AS (SELECT max(od) AS latest, min(od) AS earliest, count(od) AS total_dates, "
    f"count(*) FILTER (od >= {NOW} - INTERVAL 30 DAYS) AS recent_records FROM o),\n"
    f"timeliness_check AS (SELECT *, (epoch({NOW}) - epoch(latest)) / 3600.0::DOUBLE AS hours, "
    "recent_records::DOUBLE / total_dates AS ratio FROM timely)"
)


def _distribution(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", avg(d.{c})::DOUBLE AS dirty_mean, stddev_samp(d.{c})::DOUBLE AS dirty_std, "
        f"count(d.{c}) AS dirty_count, (SELECT avg({c})::DOUBLE FROM clean_orders) AS clean_mean, "
        f"(SELECT stddev_samp({c})::DOUBLE FROM clean_orders) AS clean_std, "
        f"(SELECT count(*) FROM clean_orders) AS clean_count FROM o d"
    )


ACCURACY = (
    "distributions AS (" + _union([_distribution(c) for c in NUMERIC]) + "),\n"
    "accuracy_check AS (SELECT *, abs(dirty_mean - clean_mean) / (abs(clean_mean) + 1e-10) AS mean_shift "
    "FROM distributions)"
)

_RATE_RESULT = (
    "round({r}, 6) AS {name}, {r} <= 0.02 AS passed, round(greatest(0, 1 - {r} / 0.05), 6)::DOUBLE AS score, "
    "0.02::DOUBLE AS threshold"
)


def _rate_result(rate: str, name: str) -> str:
    return _RATE_RESULT.format(r=rate, name=name)


ALL_FAMILIES = (NULL_RATES, EXACT, KEYS, FORMAT, FUTURE, RANGE, REFERENCE, ARITHMETIC, MAPPING, TIMELY, ACCURACY)

SINGLES = "singles AS (" + _union(
    [
        "SELECT 'completeness' AS dimension, 'null_rate_' || \"column\" AS \"check\", \"column\", passed, score, threshold, "
        "null_rate AS basis FROM null_rates",
        "SELECT 'uniqueness', 'exact_row_duplicates', NULL, duplicate_rate <= 0.03, "
        "greatest(0, 1 - duplicate_rate / 0.03), 0.03, round(duplicate_rate, 4) FROM exact_dups",
        "SELECT 'uniqueness', 'key_duplicates_order_id', 'order_id', duplicate_rate <= 0.03, "
        "greatest(0, 1 - duplicate_rate / 0.03), 0.03, round(duplicate_rate, 4) FROM key_dups",
        "SELECT 'validity', 'email_format', 'customer_email', validity_rate >= 0.90, least(1, validity_rate / 0.90), 0.90, "
        "least(1, validity_rate / 0.90) FROM format_check",
        "SELECT 'validity', 'future_dates', 'order_date', future_date_rate <= 0.02, 1 - future_date_rate / 0.02, 0.02, "
        "1 - future_date_rate / 0.02 FROM future_check",
        "SELECT 'validity', 'range_check_' || \"column\", \"column\", out_of_range_rate <= 0.02, "
        "greatest(0, 1 - out_of_range_rate / 0.05), 0.02, greatest(0, 1 - out_of_range_rate / 0.05) FROM range_check",
        "SELECT 'consistency', 'referential_integrity_customer', 'customer_id', valid_rate >= 0.98, "
        "least(1, valid_rate / 0.98), 0.98, least(1, valid_rate / 0.98) FROM reference_check",
        "SELECT 'consistency', 'amount_calculation', 'total_amount', rate <= 0.02, greatest(0, 1 - rate / 0.05), 0.02, "
        "greatest(0, 1 - rate / 0.05) FROM arithmetic_check",
        "SELECT 'consistency', 'city_state_mapping', 'shipping_city', rate <= 0.02, greatest(0, 1 - rate / 0.05), 0.02, "
        "greatest(0, 1 - rate / 0.05) FROM mapping_check",
        "SELECT 'timeliness', 'data_freshness', 'order_date', hours <= 48, greatest(0, least(1, 1 - hours / 48)), 48, "
        "greatest(0, least(1, 1 - hours / 48)) FROM timeliness_check",
        "SELECT 'timeliness', 'recent_data_ratio', 'order_date', ratio >= 0.5, least(1, ratio / 0.5), 0.5, "
        "least(1, ratio / 0.5) FROM timeliness_check",
        "SELECT 'accuracy', 'distribution_comparison_' || \"column\", \"column\", mean_shift <= 0.10, "
        "greatest(0, 1 - mean_shift * 5), 0.10, greatest(0, 1 - mean_shift * 5) FROM accuracy_check",
    ]
) + ")"

OVERALLS = (
    "means AS (SELECT dimension, count(*) AS n, avg(basis)::DOUBLE AS average FROM singles GROUP BY dimension),\n"
    "overalls AS (SELECT dimension, n, average, CASE dimension WHEN 'completeness' THEN greatest(0, 1 - average) "
    "WHEN 'uniqueness' THEN greatest(0, 1 - average * 2) ELSE average END::DOUBLE AS score, "
    "CASE dimension WHEN 'uniqueness' THEN 0.95 WHEN 'consistency' THEN 0.90 WHEN 'timeliness' THEN 0.90 "
    "ELSE 0.85 END::DOUBLE AS threshold FROM means)"
)
CHECKS = (
    'quality AS (SELECT dimension, "check", "column", passed, score::DOUBLE AS score, threshold::DOUBLE AS threshold '
    "FROM singles UNION ALL SELECT dimension, 'overall_' || dimension, NULL, score >= threshold, score, threshold "
    "FROM overalls)"
)
QUALITY = (*ALL_FAMILIES, SINGLES, OVERALLS, CHECKS)


def _overall(dimension: str) -> str:
    return _sql(
        "SELECT 'overall_' || dimension AS \"check\", n AS checks_aggregated, round(average, 6) AS average, "
        "round(score, 6) AS score, score >= threshold AS passed, threshold "
        f"FROM overalls WHERE dimension = '{dimension}'",
        *ALL_FAMILIES,
        SINGLES,
        OVERALLS,
    )


CHECK_LISTING = (
    'SELECT \'dirty_orders\' AS dataset, dimension, "check", "column", passed, round(score, 6) AS score, threshold, '
    "'2026-02-01 00:00:00' AS ts FROM "
)


def _details(check: str, source: str, numbers: str = "", texts: str = "") -> str:
    """Rows (check, field, number, text) from columns of a family, given as "field=expression" or by the field's name."""
    parts = []
    for fields, is_text in ((numbers, False), (texts, True)):
        for field in filter(None, fields.split()):
            name, _, expression = field.partition("=")
            value = f"NULL::DOUBLE AS number, ({expression or name})::VARCHAR AS text" if is_text else f"round(({expression or name})::DOUBLE, 6) AS number, NULL AS text"
            parts.append(f"SELECT {check} AS \"check\", '{name}' AS field, {value} FROM {source}")
    return _union(parts)


_COLUMN = '"column"'
QUALITY_DETAILS = [
    _details(f"'null_rate_' || {_COLUMN}", "null_rates", "total_rows null_count empty_string_count total_missing null_rate", f"column={_COLUMN}"),
    _details("'exact_row_duplicates'", "exact_dups", "total_rows duplicate_rows duplicate_rate"),
    _details("'key_duplicates_order_id'", "key_dups", "total_rows duplicate_keys duplicate_rate", "key_column"),
    _details("'email_format'", "format_check", "values_checked valid invalid=values_checked-valid validity_rate", "column='customer_email'"),
    _details("'future_dates'", "future_check", "total_rows future_dates future_date_rate parse_failures parse_success_rate", "column='order_date'"),
    _details(f"'range_check_' || {_COLUMN}", "range_check", "range_min range_max values_checked out_of_range out_of_range_rate actual_min actual_max", f"column={_COLUMN}"),
    _details("'referential_integrity_customer'", "reference_check", "total_rows valid_references=total_rows-orphan_records orphan_records orphan_rate valid_rate", "column='customer_id'"),
    _details("'amount_calculation'", "arithmetic_check", "rows_checked inconsistent_rows=bad inconsistency_rate=rate", "check='amount_calculation'"),
    _details("'city_state_mapping'", "mapping_check", "rows_checked mismatched=bad mismatch_rate=rate", "check='city_state_mapping'"),
    _details("'data_freshness'", "timeliness_check", "hours_since_update=hours", "column='order_date' most_recent_record=latest"),
    _details("'recent_data_ratio'", "timeliness_check", "total_dates recent_records recent_ratio=ratio", "column='order_date' min_date=earliest max_date=latest"),
    _details(f"'distribution_comparison_' || {_COLUMN}", "accuracy_check", "dirty_mean clean_mean mean_shift dirty_std clean_std dirty_count clean_count", f"column={_COLUMN}"),
    _details("'overall_' || dimension", "overalls", "checks_aggregated=n average"),
]
ANOMALY_DETAILS = [
    _details(f"'iqr_outliers_' || {_COLUMN}", f"(SELECT * FROM outlier_counts JOIN bounds USING ({_COLUMN}) WHERE method='iqr')", "q1 q3 iqr=q3-q1 lower_bound=q1-1.5*(q3-q1) upper_bound=q3+1.5*(q3-q1) values_checked outlier_count outlier_rate", f"column={_COLUMN} method"),
    _details(f"method || '_' || {_COLUMN}", "(SELECT * FROM outlier_counts WHERE method <> 'iqr')", "max_abs_z=max_severity values_checked outlier_count outlier_rate", f"column={_COLUMN} method"),
]

# Anomalies


def _bounds(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS n, quantile_cont({c}::DOUBLE, 0.25) AS q1, "
        f"quantile_cont({c}::DOUBLE, 0.5) AS med, quantile_cont({c}::DOUBLE, 0.75) AS q3, avg({c})::DOUBLE AS mean, "
        f"stddev_samp({c})::DOUBLE AS std, min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, "
        f"(SELECT quantile_cont(abs({c}::DOUBLE - (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM o)), 0.5) FROM o) AS mad FROM o"
    )


LONG = "long AS (" + _union([f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS v FROM o WHERE {c} IS NOT NULL" for c in NUMERIC]) + ")"
BOUNDS = "bounds AS (" + _union([_bounds(c) for c in NUMERIC]) + ")"
DEVIATIONS = (
    "deviations AS ("
    + _union(
        [
            "SELECT l.\"column\", 'iqr' AS method, v, abs(1.0::DOUBLE * (v - (q1 + (q3 - q1) / 2)) / (q3 - q1)) AS severity, "
            "v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) AS out, n FROM long l JOIN bounds USING (\"column\") "
            "WHERE q3 > q1",
            "SELECT l.\"column\", 'zscore', v, abs((v - mean) / std), abs((v - mean) / std) > 3, n "
            'FROM long l JOIN bounds USING ("column") WHERE std > 0',
            "SELECT l.\"column\", 'modified_zscore', v, abs(0.6745::DOUBLE * (v - med) / mad), "
            "abs(0.6745::DOUBLE * (v - med) / mad) > 3, n FROM long l JOIN bounds USING (\"column\") WHERE mad > 0",
        ]
    )
    + "),\noutlier_counts AS (SELECT \"column\", method, max(n) AS values_checked, count(*) FILTER (out) AS outlier_count, "
    "count(*) FILTER (out)::DOUBLE / max(n) AS outlier_rate, max(severity) AS max_severity FROM deviations "
    'GROUP BY "column", method)'
)
OUTLIERS = (LONG, BOUNDS, DEVIATIONS)
OUTLIER_CHECKS = (
    "outlier_checks AS (SELECT CASE method WHEN 'iqr' THEN 'anomaly_iqr' ELSE 'anomaly_zscore' END AS dimension, "
    "CASE method WHEN 'iqr' THEN 'iqr_outliers_' ELSE method || '_' END || \"column\" AS \"check\", \"column\", "
    "outlier_rate <= 0.02 AS passed, greatest(0, 1 - outlier_rate / 0.05)::DOUBLE AS score, 0.02::DOUBLE AS threshold "
    "FROM outlier_counts)"
)


def _zscores(method: str) -> str:
    return _sql(
        'SELECT "column", method, round(max_severity, 6) AS max_abs_z, values_checked, outlier_count, '
        + _rate_result("outlier_rate", "outlier_rate")
        + f" FROM outlier_counts WHERE method = '{method}'",
        *OUTLIERS,
    )


def _flag(c: str, method: str) -> str:
    row = f"(SELECT {{0}} FROM bounds WHERE \"column\" = '{c}')"
    if method == "iqr":
        low, high = row.format("q1 - 1.5 * (q3 - q1)"), row.format("q3 + 1.5 * (q3 - q1)")
        condition = f"{c} < {low} OR {c} > {high}"
    elif method == "zscore":
        condition = f"abs(({c} - {row.format('mean')}) / {row.format('std')}) > 3"
    else:
        condition = f"abs(0.6745::DOUBLE * ({c} - {row.format('med')}) / {row.format('mad')}) > 3"
    return f"coalesce({condition}, false) AS {method}_{c}"


# Drift

METRICS = (
    "categories AS (SELECT day, product_category, count(*) AS c FROM dirty_orders WHERE product_category IS NOT NULL "
    "GROUP BY day, product_category),\n"
    "shares AS (SELECT day, c, sum(c) OVER (PARTITION BY day) AS t, c::DOUBLE / sum(c) OVER (PARTITION BY day) AS p "
    "FROM categories),\n"
    "entropies AS (SELECT day, max(t)::BIGINT AS \"values\", count(*) AS categories, sum(-p * ln(p + 1e-10)) AS e "
    "FROM shares GROUP BY day),\n"
    "metrics AS (SELECT d.day AS snapshot, avg((customer_email IS NULL)::INT)::DOUBLE AS null_rate_customer_email, "
    "avg((unit_price IS NULL)::INT)::DOUBLE AS null_rate_unit_price, "
    "avg((customer_age IS NULL)::INT)::DOUBLE AS null_rate_customer_age, "
    "avg(coalesce(quantity = 999, false)::INT)::DOUBLE AS outlier_quantity_999, "
    "avg(coalesce(unit_price = 999999, false)::INT)::DOUBLE AS outlier_unit_price_999999, "
    "max(e) AS category_entropy, count(*) AS order_count, avg(total_amount) AS avg_order_value "
    "FROM dirty_orders d JOIN entropies USING (day) GROUP BY d.day)"
)
METRIC_NAMES = (
    "null_rate_customer_email", "null_rate_unit_price", "null_rate_customer_age", "outlier_quantity_999",
    "outlier_unit_price_999999", "category_entropy", "order_count", "avg_order_value",
)
SERIES = "series AS (" + _union([f"SELECT '{m}' AS metric, snapshot, {m}::DOUBLE AS value FROM metrics" for m in METRIC_NAMES]) + ")"
SCORED = (
    "framed AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY snapshot) AS position, "
    "count(*) OVER (PARTITION BY metric) AS snapshots, avg(value) OVER w AS rolling_mean, "
    "greatest(stddev_pop(value) OVER w, 1e-10) AS rolling_std FROM series "
    "WINDOW w AS (PARTITION BY metric ORDER BY snapshot ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),\n"
    "scored AS (SELECT *, (value - rolling_mean) / rolling_std AS z_score, "
    "position > 5 AND abs((value - rolling_mean) / rolling_std) > 2 AS alert FROM framed),\n"
    "drift AS (SELECT metric, max(snapshots) AS snapshots, count(*) FILTER (alert) AS drift_events, "
    "count(*) FILTER (alert)::DOUBLE / (max(snapshots) - 5) AS drift_rate FROM scored GROUP BY metric)"
)
DRIFT = (METRICS, SERIES, SCORED)
ANOMALY = (
    *OUTLIERS,
    OUTLIER_CHECKS,
    *DRIFT,
    "anomaly AS (SELECT * FROM outlier_checks UNION ALL SELECT 'anomaly_drift', 'drift_' || metric, NULL, "
    "drift_rate <= 0.05, greatest(0, 1 - drift_rate * 10)::DOUBLE, 0.05::DOUBLE FROM drift)",
)
DRIFT_LISTING = (
    "SELECT metric, snapshot, round(value, 4) AS value, round(rolling_mean, 4) AS rolling_mean, "
    "round(rolling_std, 4) AS rolling_std, round(z_score, 4) AS z_score FROM scored WHERE alert"
)

# Scores


def _dimension_scores(checks: str, name: str) -> str:
    return (
        f"{name} AS (SELECT dimension, coalesce(avg(score) FILTER (NOT starts_with(\"check\", 'overall_')), 0)::DOUBLE "
        f"AS score FROM {checks} GROUP BY dimension)"
    )


QUALITY_SCORES = (*QUALITY, _dimension_scores("quality", "quality_scores"))
ANOMALY_SCORES = (*ANOMALY, _dimension_scores("anomaly", "anomaly_scores"))
TOTAL = (
    "total AS (SELECT count(*) AS dimensions, sum(score * w) / sum(w) AS overall FROM (SELECT score, "
    "CASE dimension WHEN 'completeness' THEN 0.25 WHEN 'validity' THEN 0.25 WHEN 'consistency' THEN 0.15 "
    "WHEN 'timeliness' THEN 0.15 ELSE 0.20 END::DOUBLE AS w FROM quality_scores))"
)
STATUS = "CASE WHEN overall < 0.50 THEN 'critical' WHEN overall < 0.75 THEN 'warning' ELSE 'pass' END AS status"
MERGED = (
    "merged AS (SELECT dimension, coalesce(a.score, q.score) AS score FROM quality_scores q "
    "FULL JOIN anomaly_scores a USING (dimension)),\n"
    "all_checks AS (SELECT passed FROM quality UNION ALL SELECT passed FROM anomaly)"
)

# Profiles


def _cells(columns: list[str], source: str) -> str:
    return _union([f"SELECT '{c}' AS \"column\", {c}::VARCHAR AS value FROM {source}" for c in columns])


def _type(c: str) -> str:
    return "string" if c not in NUMERIC else ("double" if c in ("unit_price", "total_amount") else "bigint")


def _base_profile(name: str, columns: dict[str, str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, '{'categorical' if t == 'string' else 'numeric'}' AS kind, "
        f"count(*) AS total_rows, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"round(count(*) FILTER ({c} IS NULL)::DOUBLE / count(*), 4) AS null_rate, "
        f"count(DISTINCT {c}) AS distinct_count, round(count(DISTINCT {c})::DOUBLE / count(*), 4) AS cardinality_ratio "
        f"FROM {source}"
        for c, t in columns.items()
    ]
    return f"{name} AS ({_union(parts)})"


ORDER_TYPES = {c: _type(c) for c in TABLE_COLUMNS}
CUSTOMER_TYPES = {"customer_id": "string", "customer_name": "string"}


def _numbers(name: str, source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count({c}) AS \"values\", skewness({c})::DOUBLE AS skewness, "
        f"kurtosis({c})::DOUBLE AS kurtosis, count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives, "
        f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, avg({c})::DOUBLE AS mean, stddev_samp({c})::DOUBLE AS std, "
        f"quantile_cont({c}::DOUBLE, 0.5) AS median, quantile_cont({c}::DOUBLE, 0.25) AS p25, "
        f"quantile_cont({c}::DOUBLE, 0.75) AS p75 FROM {source}"
        for c in NUMERIC
    ]
    return f"{name} AS ({_union(parts)})"


def _flags(name: str, base: str, numbers: str | None) -> str:
    joined = f'{base} LEFT JOIN {numbers} USING ("column")' if numbers else base
    always = [
        "SELECT \"column\", CASE WHEN null_rate > 0.25 THEN 'critical' ELSE 'warning' END AS severity, 'missing' AS flag, "
        f"printf('empty in %.1f%%', null_rate * 100) || ' of the rows' AS message FROM {base} WHERE null_rate > 0.10",
        "SELECT \"column\", 'info', 'low_cardinality', 'only ' || distinct_count || ' different values in ' "
        f"|| total_rows || ' rows' FROM {base} WHERE kind = 'categorical' AND cardinality_ratio < 0.01 AND distinct_count < 5",
        "SELECT \"column\", 'info', 'high_cardinality', 'nearly every row differs: ' || distinct_count || "
        f"' values, perhaps an identifier' FROM {base} WHERE kind = 'categorical' AND cardinality_ratio > 0.95 "
        "AND distinct_count > 100",
    ]
    numeric = [
        "SELECT \"column\", 'warning', 'skewed', printf('lopsided values, skew %.2f', skewness) "
        f"FROM {joined} WHERE abs(skewness) > 2",
        "SELECT \"column\", 'info', 'mostly_zero', printf('zero in %.0f%%', zeros / \"values\" * 100) || ' of the filled cells' "
        f'FROM {joined} WHERE zeros / "values" > 0.5 AND distinct_count > 2',
        "SELECT \"column\", 'info', 'mostly_negative', 'below zero in ' || negatives || ' of ' || \"values\" || ' filled cells' "
        f'FROM {joined} WHERE negatives / "values" > 0.5',
    ]
    return f"{name} AS ({_union(always + (numeric if numbers else []))})"


def _table_row(label: str, base: str, flags: str, types: dict[str, str]) -> str:
    histogram = {t: list(types.values()).count(t) for t in types.values()}
    text = ",".join(f"{t}:{n}" for t, n in sorted(histogram.items()))
    critical = f"(SELECT count(*) FROM {flags} WHERE severity = 'critical')"
    warning = f"(SELECT count(*) FROM {flags} WHERE severity = 'warning')"
    return (
        f"SELECT '{label}' AS table_name, max(total_rows) AS row_count, count(*) AS column_count, '{text}' AS types, "
        f"{critical} AS critical_flags, {warning} AS warning_flags, CASE WHEN {critical} > 0 THEN 'critical' "
        f"WHEN {warning} > 3 THEN 'warning' ELSE 'good' END AS health FROM {base}"
    )


ORDER_PROFILE = (_base_profile("base_o", ORDER_TYPES, "o"), _numbers("numbers_o", "o"), _flags("flags_o", "base_o", "numbers_o"))
CATALOG = (
    *ORDER_PROFILE,
    _base_profile("base_c", CUSTOMER_TYPES, "customers_ref"),
    _flags("flags_c", "base_c", None),
    _base_profile("base_g", ORDER_TYPES, "clean_orders"),
    _numbers("numbers_g", "clean_orders"),
    _flags("flags_g", "base_g", "numbers_g"),
)
VALUE_COUNTS = (
    "cells AS (" + _cells(STRINGS, "o") + "),\n"
    'value_counts AS (SELECT "column", value, count(*) AS copies FROM cells WHERE value IS NOT NULL GROUP BY ALL),\n'
    'value_shares AS (SELECT *, sum(copies) OVER (PARTITION BY "column") AS n, '
    'copies::DOUBLE / sum(copies) OVER (PARTITION BY "column") AS p FROM value_counts)'
)

# History

HISTORY = (
    METRICS,
    "snapshots AS (SELECT TIMESTAMP '2026-01-01 00:00:00' + (snapshot - 1)::INT * INTERVAL 1 DAY AS ts, "
    "1 - (null_rate_customer_email + null_rate_unit_price + null_rate_customer_age) / 3 AS overall_score, "
    "((null_rate_customer_email <= 0.15)::INT + (null_rate_unit_price <= 0.10)::INT "
    "+ (null_rate_customer_age <= 0.05)::INT)::BIGINT AS num_passed FROM metrics),\n"
    "history AS (SELECT ts, overall_score, CASE WHEN overall_score < 0.75 THEN 'critical' WHEN overall_score < 0.85 "
    "THEN 'warning' ELSE 'pass' END AS status, 3::BIGINT AS num_checks, num_passed, 3 - num_passed AS num_failed, "
    "'full' AS run_type FROM snapshots),\n"
    f"recent AS (SELECT * FROM history WHERE ts >= {NOW} - INTERVAL 30 DAYS)",
)
HISTORY_ROW = (
    "CAST(ts AS VARCHAR) AS ts, round(overall_score, 6) AS overall_score, status, num_checks, num_passed, num_failed, run_type, "
    "CAST(ts::DATE AS VARCHAR) AS run_date, 1::INT AS scored, round(overall_score, 6) AS completeness"
)


def _scores(table: str, dimensions: tuple[str, ...]) -> str:
    """A report's scores by dimension, rounded as in the report."""
    cells = ", ".join(f"(SELECT round(score, 4) FROM {table} WHERE dimension = '{d}') AS {d}" for d in dimensions)
    return f"(SELECT count(*)::INT FROM {table}) AS scored, {cells}"


QUALITY_DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency", "timeliness", "accuracy")
ANOMALY_DIMENSIONS = ("anomaly_iqr", "anomaly_zscore", "anomaly_drift")

_PREDICATES = (
    ("positive_total", "total_amount > 0", 0.99, "true"),
    ("plausible_quantity", "quantity BETWEEN 1 AND 100", 0.995, "true"),
    ("paid_orders_have_city", "shipping_city IS NOT NULL", 0.9, "payment_method IS NOT NULL"),
)


def _predicate(name: str, condition: str, minimum: float, scope: str) -> str:
    rate = f"count(*) FILTER ({scope} AND {condition})::DOUBLE / count(*) FILTER ({scope})"
    return (
        f"SELECT '{name}' AS \"check\", count(*) FILTER ({scope}) AS rows_checked, "
        f"count(*) FILTER ({scope} AND {condition}) AS satisfied, round({rate}, 6) AS satisfied_rate, "
        f"{rate} >= {minimum} AS passed, round(least(1, {rate} / {minimum}), 6)::DOUBLE AS score, "
        f"{minimum}::DOUBLE AS threshold FROM o"
    )


def _copies(source: str, keys: tuple[str, ...]) -> str:
    return (
        f"SELECT '{','.join(keys)}' AS key_column, total_rows, duplicate_keys, {DUP_RESULT} FROM (SELECT "
        "sum(c)::BIGINT AS total_rows, sum(c - 1)::BIGINT AS duplicate_keys, sum(c - 1)::DOUBLE / sum(c)::DOUBLE "
        f"AS duplicate_rate FROM (SELECT count(*) AS c FROM {source} GROUP BY {', '.join(keys)}))"
    )


def _histogram(source: str, column: str) -> str:
    return (
        f"span AS (SELECT min({column}) AS lo, max({column}) AS hi, least(count(DISTINCT {column}), 50) AS bins FROM {source}),\n"
        f"binned AS (SELECT least(floor(bins * ({column} - lo) / (hi - lo))::BIGINT + 1, bins) AS bin, lo, hi, bins "
        f"FROM {source}, span WHERE {column} IS NOT NULL)"
    )


HISTOGRAM_ROWS = (
    "SELECT bin, round(lo + (hi - lo) * (bin - 1) / bins, 6) AS bin_start, round(lo + (hi - lo) * bin / bins, 6) AS bin_end, "
    "count(*) AS count FROM binned GROUP BY bin, lo, hi, bins"
)


def _null_pct(source: str, columns: list[str], name: str) -> str:
    return _union(
        [f"SELECT '{c}' AS \"column\", avg(({c} IS NULL)::INT)::DOUBLE * 100 AS {name} FROM {source}" for c in columns]
    )


def _inspect(c: str) -> str:
    kind = "bigint" if c == "day" else _type(c)
    return (
        f"SELECT '{c}' AS column_name, '{kind}' AS dtype, count(*) > count({c}) AS nullable, min({c})::VARCHAR AS sample, "
        + (f"max(length({c}))::INT" if kind == "string" else "NULL::INT")
        + ' AS max_length, NULL::VARCHAR AS "default" '
        "FROM dirty_orders"
    )


def _datetime(table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS \"column\", count({column}) AS \"values\", "
        f"CAST(min({column}) AS VARCHAR) AS oldest, CAST(max({column}) AS VARCHAR) AS most_recent, "
        f"floor(epoch(max({column}) - min({column})) / 86400)::BIGINT AS range_days FROM {table}"
    )


def _document_profile() -> str:
    source = "documents LEFT JOIN labels USING (doc_id)"
    types = {
        "doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint",
        "quality": "int", "toxic": "int",
    }
    return f"WITH {_base_profile('b', types, source)} SELECT * FROM b"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["schema_inspect"] = _sql(_union([_inspect(c) for c in ORDER_COLUMNS]))
    out["union_snapshots"] = _sql(
        "SELECT order_id, quantity, day, CASE WHEN day > 10 THEN payment_method END AS payment_method FROM dirty_orders"
    )
    out["latest_report"] = _sql(f"SELECT {HISTORY_ROW} FROM history ORDER BY history.ts DESC LIMIT 1", *HISTORY)

    out["completeness_null_rate"] = _sql(
        'SELECT "column", total_rows, null_count, empty_string_count, total_missing, round(null_rate, 6) AS null_rate, '
        "passed, round(score, 6) AS score, threshold FROM null_rates",
        NULL_RATES,
    )
    for dimension in ("completeness", "uniqueness", "validity", "consistency", "timeliness", "accuracy"):
        out[f"{dimension}_overall"] = _overall(dimension)
    out["uniqueness_exact"] = _sql(f"SELECT total_rows, duplicate_rows, {DUP_RESULT} FROM exact_dups", EXACT)
    out["uniqueness_key"] = _sql(f"SELECT key_column, total_rows, duplicate_keys, {DUP_RESULT} FROM key_dups", KEYS)
    out["uniqueness_composite_key"] = _union(
        [_copies("lineitem", ("l_orderkey", "l_linenumber")), _copies("lineitem", ("l_orderkey",))]
    )
    out["duplicate_documents"] = _copies("documents", ("text",))
    out["validity_format"] = _sql(
        "SELECT 'customer_email' AS \"column\", values_checked, valid, values_checked - valid AS invalid, "
        "round(validity_rate, 6) AS validity_rate, validity_rate >= 0.90 AS passed, "
        "round(least(1, validity_rate / 0.90), 6)::DOUBLE AS score, 0.90::DOUBLE AS threshold FROM format_check",
        FORMAT,
    )
    out["validity_invalid_samples"] = _sql(
        f"SELECT customer_email AS value FROM o WHERE NOT regexp_matches(customer_email, '{EMAIL}') ORDER BY 1 LIMIT 5"
    )
    out["validity_future_dates"] = _sql(
        "SELECT 'order_date' AS \"column\", total_rows, future_dates, round(future_date_rate, 6) AS future_date_rate, "
        "future_date_rate <= 0.02 AS passed, round(1 - future_date_rate / 0.02, 6)::DOUBLE AS score, "
        "0.02::DOUBLE AS threshold FROM future_check",
        FUTURE,
    )
    out["validity_parse_rate"] = _sql(
        "SELECT 'order_date' AS \"column\", total_rows, parse_failures, round(parse_success_rate, 6) AS parse_success_rate "
        "FROM future_check",
        FUTURE,
    )
    out["validity_range"] = _sql(
        'SELECT "column", range_min, range_max, values_checked, out_of_range, actual_min, actual_max, '
        + _rate_result("out_of_range_rate", "out_of_range_rate")
        + " FROM range_check",
        RANGE,
    )
    out["consistency_referential"] = _sql(
        "SELECT 'customer_id' AS \"column\", total_rows, total_rows - orphan_records AS valid_references, orphan_records, "
        "round(orphan_rate, 6) AS orphan_rate, round(valid_rate, 6) AS valid_rate, valid_rate >= 0.98 AS passed, "
        "round(least(1, valid_rate / 0.98), 6)::DOUBLE AS score, 0.98::DOUBLE AS threshold FROM reference_check",
        REFERENCE,
    )
    rounded = ", ".join(
        f"round({c}, 6) AS {c}" if c in ("unit_price", "total_amount") else c for c in ORDER_COLUMNS
    )
    out["orphan_rows"] = _sql(
        f"SELECT {rounded} FROM dirty_orders WHERE customer_id NOT IN (SELECT customer_id FROM customers_ref)"
    )
    out["consistency_arithmetic"] = _sql(
        "SELECT 'amount_calculation' AS \"check\", rows_checked, bad AS inconsistent_rows, "
        + _rate_result("rate", "inconsistency_rate")
        + " FROM arithmetic_check",
        ARITHMETIC,
    )
    out["lineitem_arithmetic"] = (
        "WITH priced AS (SELECT l_extendedprice AS a, l_quantity * p_retailprice AS e FROM lineitem JOIN part "
        "ON l_partkey = p_partkey WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND p_retailprice IS NOT NULL), "
        "c AS (SELECT count(*) AS n, count(*) FILTER (abs(a - e) / CASE WHEN e = 0 THEN 1 ELSE abs(e) END > 0.005) AS bad "
        "FROM priced), r AS (SELECT *, bad::DOUBLE / n AS rate FROM c) "
        "SELECT 'price_per_unit' AS \"check\", n AS rows_checked, bad AS inconsistent_rows, "
        + _rate_result("rate", "inconsistency_rate")
        + " FROM r"
    )
    out["consistency_mapping"] = _sql(
        "SELECT 'city_state_mapping' AS \"check\", rows_checked, bad AS mismatched, "
        + _rate_result("rate", "mismatch_rate")
        + " FROM mapping_check",
        MAPPING,
    )
    out["timeliness_freshness"] = _sql(
        "SELECT 'order_date' AS \"column\", CAST(latest AS VARCHAR) AS most_recent_record, round(hours, 6) AS hours_since_update, "
        "hours <= 48 AS passed, round(greatest(0, least(1, 1 - hours / 48)), 6)::DOUBLE AS score, 48::DOUBLE AS threshold "
        "FROM timeliness_check",
        TIMELY,
    )
    out["timeliness_recent"] = _sql(
        "SELECT 'order_date' AS \"column\", total_dates, recent_records, round(ratio, 6) AS recent_ratio, "
        "CAST(earliest AS VARCHAR) AS min_date, CAST(latest AS VARCHAR) AS max_date, ratio >= 0.5 AS passed, "
        "round(least(1, ratio / 0.5), 6)::DOUBLE AS score, 0.5::DOUBLE AS threshold FROM timeliness_check",
        TIMELY,
    )
    out["accuracy_distribution"] = _sql(
        'SELECT "column", round(dirty_mean, 6) AS dirty_mean, round(clean_mean, 6) AS clean_mean, '
        "round(mean_shift, 6) AS mean_shift, round(dirty_std, 6) AS dirty_std, round(clean_std, 6) AS clean_std, "
        "dirty_count, clean_count, mean_shift <= 0.10 AS passed, round(greatest(0, 1 - mean_shift * 5), 6)::DOUBLE AS score, "
        "0.10::DOUBLE AS threshold FROM accuracy_check",
        ACCURACY,
    )
    out["custom_check"] = _sql(_union([_predicate(*p) for p in _PREDICATES]))
    out["quality_checks"] = _sql(CHECK_LISTING + "quality", *QUALITY)

    out["anomaly_iqr"] = _sql(
        'SELECT "column", method, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, '
        "round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound, values_checked, "
        "outlier_count, " + _rate_result("outlier_rate", "outlier_rate")
        + " FROM outlier_counts JOIN bounds USING (\"column\") WHERE method = 'iqr'",
        *OUTLIERS,
    )
    out["checks_while_writing"] = _sql(
        f"SELECT * FROM ({CHECK_LISTING}quality) WHERE dimension <> 'uniqueness' AND \"check\" NOT LIKE 'overall%' AND "
        "\"check\" NOT IN ('referential_integrity_customer', 'city_state_mapping')",
        *QUALITY,
    )
    out["snapshot_scan"] = _sql(
        "SELECT day::BIGINT AS day, count(*) AS rows, count(nullif(customer_email, '')) AS emails, "
        "count(TRY_CAST(order_date AS TIMESTAMP)) AS dated, sum(quantity)::BIGINT AS quantity, round(sum(total_amount), 2) AS amount "
        "FROM dirty_orders WHERE day BETWEEN 3 AND 5 GROUP BY day"
    )
    out["quality_checks_incremental"] = out["quality_checks"]
    out["cumulative_duplicates"] = _sql(
        "SELECT r.snapshot, rows, new_keys, rows - new_keys AS repeated, (sum(rows) OVER w)::BIGINT AS total_rows, "
        "(sum(rows - new_keys) OVER w)::BIGINT AS total_repeated, round((sum(rows - new_keys) OVER w)::DOUBLE / sum(rows) OVER w, 6) "
        "AS duplicate_rate FROM (SELECT day::BIGINT AS snapshot, count(*) AS rows FROM dirty_orders GROUP BY day) r JOIN "
        "(SELECT first AS snapshot, count(*) AS new_keys FROM (SELECT min(day) AS first FROM dirty_orders GROUP BY order_id) GROUP BY first) k "
        "USING (snapshot) WINDOW w AS (ORDER BY snapshot)"
    )
    out["anomaly_iqr_sketch"] = _sql(
        'SELECT "column", values_checked, true AS q1_within, true AS q3_within, true AS rate_within FROM outlier_counts '
        "WHERE method = 'iqr'",
        *OUTLIERS,
    )
    quantiles = ", ".join(f"round(quantile_cont({{0}}::DOUBLE, {p}), 6) AS {n}" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("p99", 0.99)))
    out["sketch_quantiles"] = _sql(
        _union([f"SELECT '{c}' AS \"column\", {quantiles.format(c)} FROM dirty_orders WHERE day BETWEEN 11 AND 20" for c in NUMERIC])
    )
    out["anomaly_zscore"] = _zscores("zscore")
    out["anomaly_mad"] = _zscores("modified_zscore")
    out["outlier_samples"] = _sql(
        'SELECT "column", method, round(v, 6) AS value, round(severity, 6) AS severity, rank::INT AS rank FROM ('
        'SELECT *, row_number() OVER (PARTITION BY "column", method ORDER BY severity DESC, v) AS rank FROM deviations '
        "WHERE out) WHERE rank <= 10",
        *OUTLIERS,
    )
    flags = ", ".join(_flag(c, m) for m in ("iqr", "zscore", "modified_zscore") for c in NUMERIC)
    out["outlier_rows"] = _sql(f"SELECT order_id, day, {flags} FROM dirty_orders", BOUNDS)
    out["median_impute"] = _sql(
        "SELECT order_id, "
        + ", ".join(f"round(coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM o)), 6) AS {c}" for c in NUMERIC)
        + " FROM o"
    )
    out["event_value_outliers"] = (
        "WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, count(value) AS n FROM events), "
        "c AS (SELECT q1, q3, n, count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS bad "
        "FROM events, b GROUP BY q1, q3, n), r AS (SELECT *, bad::DOUBLE / n AS rate FROM c) "
        "SELECT 'value' AS \"column\", 'iqr' AS method, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
        "round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound, n AS values_checked, "
        "bad AS outlier_count, " + _rate_result("rate", "outlier_rate") + " FROM r"
    )

    out["daily_metrics"] = _sql(
        "SELECT snapshot, "
        + ", ".join(m if m == "order_count" else f"round({m}, 6) AS {m}" for m in METRIC_NAMES)
        + " FROM metrics",
        METRICS,
    )
    out["category_entropy"] = _sql(
        'SELECT day AS snapshot, "values", categories, round(e, 6) AS category_entropy FROM entropies', METRICS
    )
    out["drift_events"] = _sql(DRIFT_LISTING, *DRIFT)
    out["drift_summary"] = _sql(
        "SELECT metric, snapshots, drift_events, round(drift_rate, 6) AS drift_rate, drift_rate <= 0.05 AS passed, "
        "round(greatest(0, 1 - drift_rate * 10), 6)::DOUBLE AS score, 0.05::DOUBLE AS threshold, drift_events::INT AS alerts FROM drift",
        *DRIFT,
    )
    out["drift_summary_alerts"] = _sql(
        "SELECT metric, snapshot, round(value, 4) AS value, round(rolling_mean, 4) AS rolling_mean, round(z_score, 4) AS z_score "
        "FROM scored WHERE alert",
        *DRIFT,
    )
    out["quality_details"] = _sql(_union(QUALITY_DETAILS), *QUALITY)
    out["anomaly_details"] = _sql(_union(ANOMALY_DETAILS), *OUTLIERS)
    out["custom_detector"] = _sql(
        "SELECT 'dirty_orders' AS dataset, 'anomaly_sentinel' AS dimension, 'sentinel_quantity' AS \"check\", 'quantity' AS \"column\", "
        "f / n <= 0.001 AS passed, round(greatest(0, 1 - f / n * 100), 6) AS score, 0.001::DOUBLE AS threshold, "
        "'{\"rows\":' || n || ',\"found\":' || found || '}' AS details, '2026-02-01 00:00:00' AS ts "
        "FROM (SELECT count(*) AS n, count(*) FILTER (quantity = 999) AS found, (count(*) FILTER (quantity = 999))::DOUBLE AS f FROM o)"
    )
    out["lookup_conflicts"] = _sql(
        "SELECT shipping_city AS key, count(DISTINCT shipping_state) AS \"values\", count(*) AS rows, min(shipping_state) AS least, "
        "max(shipping_state) AS greatest FROM o WHERE shipping_city IS NOT NULL AND shipping_state IS NOT NULL GROUP BY shipping_city "
        "HAVING count(DISTINCT shipping_state) > 1"
    )
    out["category_shares"] = _sql(
        "SELECT day AS snapshot, product_name AS category, count(*) AS rows, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY day), 6) "
        "AS share FROM dirty_orders WHERE product_name IS NOT NULL GROUP BY day, product_name"
    )
    out["preview"] = _sql(
        "SELECT order_id, customer_email, day FROM dirty_orders ORDER BY customer_email NULLS FIRST, order_id, day LIMIT 12"
    )
    out["drift_timeline"] = _sql(
        "SELECT metric, snapshot, round(value, 6) AS value FROM framed "
        "WHERE (position - 1) % greatest(1, snapshots // 10) = 0",
        *DRIFT,
    )
    out["anomaly_checks"] = _sql(CHECK_LISTING + "anomaly", *ANOMALY)

    out["dimension_scores"] = _sql("SELECT dimension, round(score, 6) AS score FROM quality_scores", *QUALITY_SCORES)
    out["overall_score"] = _sql(
        f"SELECT dimensions, round(overall, 6) AS overall_score, {STATUS} FROM total", *QUALITY_SCORES, TOTAL
    )
    out["report_totals"] = _sql(
        f"SELECT 'dirty_orders' AS dataset, round(overall, 4) AS overall_score, {STATUS}, "
        "(SELECT count(*) FROM quality) AS num_checks, (SELECT count(*) FROM quality WHERE passed) AS num_passed, "
        "(SELECT count(*) FROM quality WHERE NOT passed) AS num_failed, '2026-02-01 00:00:00' AS ts, "
        + _scores("quality_scores", QUALITY_DIMENSIONS) + " FROM total",
        *QUALITY_SCORES,
        TOTAL,
    )
    out["dimension_status"] = _sql(
        "SELECT dimension, round(score, 6) AS score, CASE WHEN score >= 0.75 THEN 'PASS' WHEN score >= 0.5 THEN 'WARN' "
        "ELSE 'FAIL' END AS status FROM quality_scores ORDER BY dimension",
        *QUALITY_SCORES,
    )
    both = (*QUALITY_SCORES, *ANOMALY_SCORES, MERGED)
    out["merged_dimensions"] = _sql("SELECT dimension, round(score, 6) AS score FROM merged", *both)
    out["merged_report"] = _sql(
        "SELECT dimensions, round(overall, 4) AS overall_score, " + STATUS + ", (SELECT count(*) FROM all_checks) AS num_checks, "
        "(SELECT count(*) FROM all_checks WHERE passed) AS num_passed, "
        "(SELECT count(*) FROM all_checks WHERE NOT passed) AS num_failed, " + _scores("merged", QUALITY_DIMENSIONS + ANOMALY_DIMENSIONS) + " "
        "FROM (SELECT count(*) AS dimensions, avg(score) AS overall FROM merged)",
        *both,
    )
    out["check_totals"] = _sql("SELECT passed, count(*) AS checks FROM quality GROUP BY passed", *QUALITY)
    out["failures_by_dimension"] = _sql(
        "SELECT dimension, count(*) AS failures FROM quality WHERE NOT passed GROUP BY dimension", *QUALITY
    )

    out["profile_base"] = _sql("SELECT * FROM base_o", ORDER_PROFILE[0])
    out["profile_documents"] = _document_profile()
    out["profile_numeric"] = _sql(
        'SELECT "column", "values", round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean, round(std, 6) AS std, '
        "round(median, 6) AS median, round(p25, 6) AS p25, round(p75, 6) AS p75, round(p75 - p25, 6) AS iqr, zeros, negatives "
        "FROM numbers_o",
        ORDER_PROFILE[1],
    )
    out["profile_moments"] = _sql(
        'SELECT "column", "values", round(skewness, 4) AS skewness, round(kurtosis, 4) AS kurtosis FROM numbers_o',
        ORDER_PROFILE[1],
    )
    out["profile_top_values"] = _sql(
        'SELECT "column", rank::INT AS rank, value, copies, round(copies / n * 100, 2) AS percentage FROM (SELECT *, '
        'row_number() OVER (PARTITION BY "column" ORDER BY copies DESC, value) AS rank FROM value_shares) WHERE rank <= 10',
        VALUE_COUNTS,
    )
    out["frequent_values"] = _sql(
        'SELECT "column", rank::INT AS rank, value, copies, round(copies / n * 100, 2) AS percentage, round(3.5::DOUBLE / 4096 * n, 6) AS bound, '
        'true AS certain FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY copies DESC, value) AS rank FROM value_shares) '
        "WHERE rank <= 10 AND copies > 3.5::DOUBLE / 4096 * n AND \"column\" IN ('product_category', 'order_status', 'payment_method', "
        "'shipping_city', 'shipping_state', 'order_id')",
        VALUE_COUNTS,
    )
    out["profile_entropy"] = _sql(
        'SELECT "column", count(*) AS distinct_count, round(sum(-p * ln(p + 1e-10)), 4) AS entropy, '
        "round(sum(-p * ln(p + 1e-10)) / CASE WHEN count(*) > 1 THEN ln(count(*)) ELSE 1 END, 4) AS normalized_entropy, "
        'round(max(copies) / max(n) * 100, 2) AS top_value_share FROM value_shares GROUP BY "column"',
        VALUE_COUNTS,
    )
    out["profile_datetime"] = _union(
        [_datetime("orders", "o_orderdate"), _datetime("events", "ts"), _datetime("lineitem", "l_shipdate")]
    )
    out["profile_flags"] = _sql('SELECT "column", severity, flag, message FROM flags_o', *ORDER_PROFILE)
    numbers = ", ".join(f"'{c}'" for c in NUMERIC)
    out["profile_samples"] = _sql(
        'SELECT "column", rank::INT AS rank, value FROM (SELECT "column", value, row_number() OVER (PARTITION BY "column" '
        f"ORDER BY CASE WHEN \"column\" IN ({numbers}) THEN TRY_CAST(value AS DOUBLE) END, value) AS rank "
        'FROM (SELECT DISTINCT "column", value FROM every_cell WHERE value IS NOT NULL)) WHERE rank <= 5',
        "every_cell AS (" + _cells(TABLE_COLUMNS, "o") + ")",
    )
    out["table_profile"] = _sql(_table_row("dirty_orders", "base_o", "flags_o", ORDER_TYPES), *ORDER_PROFILE)
    size = " + ".join("8" if c in NUMERIC else f"coalesce(strlen({c}), 0)" for c in TABLE_COLUMNS)
    out["table_size"] = _sql(
        "SELECT 'dirty_orders' AS table_name, b AS size_bytes, CASE WHEN b < 1024 THEN b || ' B' "
        "WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) ELSE printf('%.1f MB', b / 1048576) END AS size "
        f"FROM (SELECT sum({size})::BIGINT AS b FROM o)"
    )
    out["catalog"] = _sql(
        _union(
            [
                _table_row("orders", "base_o", "flags_o", ORDER_TYPES),
                _table_row("customers", "base_c", "flags_c", CUSTOMER_TYPES),
                _table_row("ground_truth", "base_g", "flags_g", ORDER_TYPES),
            ]
        ),
        *CATALOG,
    )
    out["catalog_columns"] = _sql(
        _union(
            [f"SELECT '{label}' AS table_name, * FROM {base}" for label, base in
             (("orders", "base_o"), ("customers", "base_c"), ("ground_truth", "base_g"))]
        ),
        *CATALOG,
    )
    out["cross_table"] = _sql(
        f"SELECT '{','.join(sorted(CLEAN))}' AS shared_columns, 'day' AS left_only, '' AS right_only, l AS left_rows, "
        "r AS right_rows, l - r AS row_count_diff, round((l - r) / r * 100, 2) AS row_count_diff_pct "
        "FROM (SELECT (SELECT count(*) FROM dirty_orders) AS l, (SELECT count(*) FROM clean_orders) AS r)"
    )
    out["null_rate_compare"] = _sql(
        'SELECT "column", round(dirty_null_pct, 6) AS dirty_null_pct, round(clean_null_pct, 6) AS clean_null_pct '
        'FROM d JOIN c USING ("column") WHERE dirty_null_pct > 0',
        f"d AS ({_null_pct('o', TABLE_COLUMNS, 'dirty_null_pct')})",
        f"c AS ({_null_pct('clean_orders', TABLE_COLUMNS, 'clean_null_pct')})",
    )

    newest = "SELECT * FROM recent ORDER BY ts DESC LIMIT 20"
    out["history_load"] = _sql(
        f"SELECT {HISTORY_ROW} FROM ({newest}) AS kept", *HISTORY
    )
    out["history_load_oldest"] = _sql(
        "SELECT CAST(ts AS VARCHAR) AS ts, round(overall_score, 6) AS overall_score, status FROM "
        "(SELECT * FROM recent ORDER BY ts LIMIT 20) AS kept",
        *HISTORY,
    )
    out["history_latest"] = out["latest_report"]
    out["history_trend"] = _sql(
        "SELECT round(arg_max(overall_score, ts) * 100, 1) AS current, round(min(overall_score) * 100, 1) AS min, "
        "round(max(overall_score) * 100, 1) AS max, round(avg(overall_score) * 100, 1) AS avg, "
        "CASE WHEN count(*) < 2 THEN 'stable' WHEN avg(overall_score) FILTER (position > n // 2) "
        "- avg(overall_score) FILTER (position <= n // 2) > 0.02 THEN 'improving' "
        "WHEN avg(overall_score) FILTER (position > n // 2) - avg(overall_score) FILTER (position <= n // 2) < -0.02 "
        "THEN 'degrading' ELSE 'stable' END AS trend, count(*) AS count FROM (SELECT *, row_number() OVER (ORDER BY ts) "
        "AS position, count(*) OVER () AS n FROM recent)",
        *HISTORY,
    )
    out["history_series"] = _sql(
        "SELECT CAST(ts::DATE AS VARCHAR) AS date, round(overall_score * 100, 6) AS score_pct FROM recent", *HISTORY
    )
    no_alert = "NULL::VARCHAR AS metric, NULL::BIGINT AS event_count, NULL::DOUBLE AS overall_score"
    out["alert_rules"] = _sql(
        _union(
            [
                "SELECT 'critical_score' AS type, NULL AS metric, NULL::BIGINT AS event_count, round(overall, 4) AS overall_score "
                "FROM total WHERE round(overall, 4) < 0.99",
                "SELECT 'any_failures', NULL, count(*), NULL FROM quality WHERE NOT passed HAVING count(*) > 0",
                "SELECT 'drift_events', metric, count(*), NULL FROM scored WHERE alert GROUP BY metric",
            ]
        ),
        *QUALITY_SCORES,
        TOTAL,
        *DRIFT,
    )
    out["alert_daily_summary"] = _sql(
        f"SELECT 'daily_summary' AS type, {no_alert} FROM total WHERE overall >= 0", *QUALITY_SCORES, TOTAL
    )

    out["quality_timeline"] = _sql(
        "SELECT day AS snapshot, count(*) AS order_count, round(1 - count(DISTINCT order_id)::DOUBLE / count(*), 6) AS duplicate_rate, "
        "round(avg(total_amount), 6) AS avg_order_value, round(avg((customer_email IS NULL)::INT), 6) AS null_email, "
        "round(avg((unit_price IS NULL)::INT), 6) AS null_price, round(avg((customer_age IS NULL)::INT), 6) AS null_age, "
        f"round(avg(coalesce(TRY_CAST(order_date AS TIMESTAMP) > {NOW}, false)::INT), 6) AS future_date_rate, "
        "round(avg(coalesce(quantity = 999, false)::INT), 6) AS outlier_qty, "
        "round(avg(coalesce(unit_price = 999999, false)::INT), 6) AS outlier_price, "
        "round(avg(coalesce(customer_age < 0 OR customer_age > 120, false)::INT), 6) AS invalid_age "
        "FROM dirty_orders GROUP BY day"
    )
    out["category_share"] = _sql(
        "SELECT day AS snapshot, "
        + ", ".join(
            f"round(count(*) FILTER (product_category = '{c}')::DOUBLE / count(product_category), 6) AS {c}" for c in CATEGORIES
        )
        + " FROM dirty_orders GROUP BY day"
    )
    out["histogram"] = _sql(HISTOGRAM_ROWS, _histogram("o", "total_amount"))
    out["event_histogram"] = "WITH " + _histogram("events", "value") + " " + HISTOGRAM_ROWS
    out["top_values"] = _sql(
        "SELECT product_name AS value, count(*) AS count FROM o WHERE product_name IS NOT NULL GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 20"
    )
    out["kpis"] = _sql(
        "SELECT (SELECT count(*) FROM o) AS orders, (SELECT count(*) FROM o) - (SELECT count(*) FROM clean_orders) AS orders_delta, "
        "(SELECT count(*) FROM customers_ref) AS customers, (SELECT round(sum(total_amount), 2) FROM o) AS total_revenue, "
        "count(*) AS num_checks, count(*) FILTER (passed) AS num_passed, "
        "round(count(*) FILTER (passed) / count(*) * 100, 2) AS passed_pct FROM quality",
        *QUALITY,
    )
    selected = ["customer_email", "unit_price", "shipping_city", "customer_age"]
    out["missing_share"] = _sql(
        'SELECT "column", round(missing_pct, 6) AS missing_pct FROM m', f"m AS ({_null_pct('o', selected, 'missing_pct')})"
    )
    out["outliers_by_column"] = _sql(
        'SELECT "column", method, outlier_count, round(outlier_rate, 6) AS outlier_rate, outlier_rate <= 0.02 AS passed '
        "FROM outlier_counts",
        *OUTLIERS,
    )
    out["filter_domains"] = _sql(
        _union(
            [
                "SELECT 'min_date' AS domain, CAST(min(od)::DATE AS VARCHAR) AS value FROM o",
                "SELECT 'max_date', CAST(max(od)::DATE AS VARCHAR) FROM o",
                "SELECT DISTINCT 'product_category', product_category FROM o WHERE product_category IS NOT NULL",
                "SELECT DISTINCT 'order_status', order_status FROM o WHERE order_status IS NOT NULL",
            ]
        )
    )
    rounded = ", ".join(f"round({c}, 6) AS {c}" if c in ("unit_price", "total_amount") else c for c in TABLE_COLUMNS)
    out["filtered_orders"] = _sql(
        f"SELECT {rounded} FROM o WHERE od::DATE BETWEEN DATE '2026-01-05' AND DATE '2026-01-20' "
        "AND product_category IN ('BUILDING', 'MACHINERY')"
    )
    out["event_day"] = _sql(
        "SELECT order_id, order_date, CAST(od AS VARCHAR) AS order_date_parsed, day(od)::INT AS day_of_month FROM o"
    )
    windows = (
        "WITH windows AS (SELECT date_trunc('day', ts)::TIMESTAMP AS snapshot, count(*) AS n, count(value) AS v, "
        "count(*) FILTER (value < 0 OR value > 100)::DOUBLE / count(value) AS out_of_range_rate, avg(value) AS mean_value, "
        "avg((user_id IS NULL)::INT)::DOUBLE AS null_rate_user_id FROM events GROUP BY 1)"
    )
    out["windowed_metrics"] = (
        windows + ' SELECT CAST(snapshot AS VARCHAR) AS window_start, n AS "rows", v AS "values", '
        "round(out_of_range_rate, 6) AS out_of_range_rate, round(mean_value, 6) AS mean_value, "
        "round(null_rate_user_id, 6) AS null_rate_user_id FROM windows"
    )
    series = _union(
        [
            f"SELECT '{name}' AS metric, snapshot, {column}::DOUBLE AS value FROM windows"
            for name, column in (("rows", "n"), ("values", "v"), ("out_of_range_rate",) * 2, ("mean_value",) * 2)
        ]
    )
    out["windowed_drift"] = (
        f"{windows}, series AS ({series}), {SCORED} " + DRIFT_LISTING.replace("snapshot,", "CAST(snapshot AS VARCHAR) AS snapshot,", 1)
    )
    return out
