"""References to other tables, arithmetic between columns, functional lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import RATE_PASS, RATE_ZERO_SCORE, Arithmetic, Lookup, Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import has, nan_to_null
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check


def _key_references(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Distinct keys with their row count and whether the reference table has them.

    Keys are counted before the join, so a key shared by a third of the rows is one row here. The join compares
    null-safely: a null key is known exactly if the reference holds a null.
    """
    keys = df.selectExpr(f"{sql.name(key)} AS _key").groupBy("_key").agg(F.expr("count(*) AS copies"))
    known = reference.selectExpr(f"{sql.name(key)} AS _known").distinct().selectExpr("_known", "true AS _found")
    joined = keys.join(known, F.expr("_key <=> _known"), "left")
    return joined.selectExpr("_key", "copies", "coalesce(_found, false) AS found")


def reference_check(name: str, key: str, limits: Thresholds) -> Check:
    orphan_rate = sql.rate("orphans", "rows")
    valid_rate = f"(1D - {orphan_rate})"
    return Check(
        dimension="consistency",
        name=name,
        column=key,
        metrics={"rows": "sum(copies)", "orphans": "sum(CASE WHEN found THEN 0L ELSE copies END)"},
        fields={
            "column": sql.string(key),
            "total_rows": "rows",
            "valid_references": "rows - orphans",
            "orphan_records": "orphans",
            "orphan_rate": orphan_rate,
            "valid_rate": valid_rate,
        },
        passed=f"{valid_rate} >= {sql.double(limits.min_reference_rate)}",
        score=sql.attainment(valid_rate, limits.min_reference_rate),
        threshold=limits.min_reference_rate,
        present="rows > 0",
    )


def referential(
    df: DataFrame, reference: DataFrame, limits: Thresholds = Thresholds(), roles: Roles = Roles()
) -> DataFrame:
    """Rows whose key the reference table lacks."""
    name, key = roles.reference
    return fused.flat(_key_references(df, reference, key), [reference_check(name, key, limits)])


def orphan_rows(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """The rows whose key the reference table lacks.

    A null-safe anti join: Spark broadcasts the keys if they are small and otherwise lets adaptive execution split hot
    keys of the left side.
    """
    known = reference.selectExpr(f"{sql.name(key)} AS _known").distinct()
    return df.join(known, F.expr(f"{sql.name(key)} <=> _known"), "left_anti")


def arithmetic_checks(df: DataFrame, roles: Roles) -> list[Check]:
    """Totals that differ from their expression by more than the relative tolerance."""
    return [_arithmetic_check(rule) for rule in roles.arithmetic if has(df, rule.total, *rule.inputs)]


def _arithmetic_check(rule: Arithmetic) -> Check:
    complete = " AND ".join(f"{sql.name(c)} IS NOT NULL" for c in (rule.total, *rule.inputs))
    expected = f"CAST(({rule.expression}) AS DOUBLE)"
    base = f"CASE WHEN {expected} = 0 THEN 1D ELSE abs({expected}) END"
    bad = f"{complete} AND abs({sql.as_double(rule.total)} - {expected}) / ({base}) > {sql.double(rule.tolerance)}"
    checked, wrong = sql.name(f"complete for {rule.name}"), sql.name(f"wrong in {rule.name}")
    observed = sql.rate(wrong, checked)
    return Check(
        dimension="consistency",
        name=rule.name,
        column=rule.total,
        metrics={f"complete for {rule.name}": sql.count_true(complete), f"wrong in {rule.name}": sql.count_true(bad)},
        fields={
            "check": sql.string(rule.name),
            "rows_checked": checked,
            "inconsistent_rows": wrong,
            "inconsistency_rate": observed,
        },
        passed=f"{observed} <= {sql.double(RATE_PASS)}",
        score=sql.penalty(observed, RATE_ZERO_SCORE),
        threshold=RATE_PASS,
        present=f"{checked} > 0",
    )


def arithmetic(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    df = nan_to_null(df)
    return fused.flat(df, arithmetic_checks(df, roles))


def _lookup_pairs(df: DataFrame, mapping: DataFrame, lookup: Lookup) -> DataFrame:
    """Distinct (key, value) pairs with row counts, next to the value the mapping expects."""
    pairs = df.selectExpr(f"{sql.name(lookup.key)} AS _key", f"{sql.name(lookup.value)} AS _value").dropna()
    pairs = pairs.groupBy("_key", "_value").agg(F.expr("count(*) AS copies"))
    known = mapping.groupBy(F.expr("key AS _known")).agg(F.expr("max(value) AS _expected"))
    return pairs.join(known, F.expr("_key = _known"), "left")


def lookup_conflicts(mapping: DataFrame) -> DataFrame:
    """Keys to which a mapping (columns ``key``, ``value``) gives several values, with the least and greatest of them.

    The lookup check expects the greatest one, so a mapping should have no conflicts.
    """
    found = mapping.where("key IS NOT NULL AND value IS NOT NULL").groupBy("key", "value").agg(F.expr("count(*) AS rows"))
    sums = ("count(*) AS values", "sum(rows) AS rows", "min(value) AS least", "max(value) AS greatest")
    return found.groupBy("key").agg(*map(F.expr, sums)).where("values > 1")


def lookup_check(lookup: Lookup) -> Check:
    observed = sql.rate("mismatched", "rows")
    return Check(
        dimension="consistency",
        name=lookup.name,
        column=lookup.key,
        metrics={
            "rows": "sum(copies)",
            "mismatched": "sum(CASE WHEN _expected <> '' AND _expected <> _value THEN copies ELSE 0L END)",
        },
        fields={
            "check": sql.string(lookup.name),
            "rows_checked": "rows",
            "mismatched": "mismatched",
            "mismatch_rate": observed,
        },
        passed=f"{observed} <= {sql.double(RATE_PASS)}",
        score=sql.penalty(observed, RATE_ZERO_SCORE),
        threshold=RATE_PASS,
        present="rows > 0",
    )


def mapping(df: DataFrame, known: DataFrame, lookup: Lookup = Roles().lookup) -> DataFrame:
    """Rows whose value differs from the one the mapping (columns ``key``, ``value``) gives; unknown keys pass."""
    return fused.flat(_lookup_pairs(df, known, lookup), [lookup_check(lookup)])


def aggregated_rows(
    df: DataFrame, limits: Thresholds, roles: Roles, reference: DataFrame | None, known: DataFrame | None
) -> list[DataFrame]:
    """Check rows of the checks that need their own grouping."""
    name, key = roles.reference
    parts = []
    if reference is not None and has(df, key):
        parts.append(fused.check_rows(_key_references(df, reference, key), [reference_check(name, key, limits)]))
    if known is not None and has(df, roles.lookup.key, roles.lookup.value):
        parts.append(fused.check_rows(_lookup_pairs(df, known, roles.lookup), [lookup_check(roles.lookup)]))
    return parts


def overall(
    df: DataFrame,
    reference: DataFrame | None = None,
    known: DataFrame | None = None,
    limits: Thresholds = Thresholds(),
    roles: Roles = Roles(),
) -> DataFrame:
    df = nan_to_null(df)
    parts = aggregated_rows(df, limits, roles, reference, known)
    single_pass = arithmetic_checks(df, roles)
    if single_pass:
        parts.append(fused.check_rows(df, single_pass))
    if not parts:
        raise ValueError("no consistency check applies to this table")
    return fused.overall(reduce(DataFrame.unionByName, parts), "consistency", limits)
