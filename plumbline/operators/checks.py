"""Fused checks: many checks share one aggregation over the table.

A ``Check`` names the aggregates it needs and says how its result follows from them. ``measure`` computes the
aggregates of all checks in one pass and gives one row, from which ``flat`` (typed columns of one check family) or
``check_rows`` (the common check schema) unfold the results. Rows are never multiplied by the number of columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import Thresholds
from plumbline.functions import sqltext as sql

# One aggregation stays within this many aggregates so that its generated code remains compilable.
MAX_AGGREGATES = 120

DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency", "timeliness", "accuracy")


@dataclass(frozen=True)
class Check:
    """One check, in SQL text.

    ``inputs`` are row expressions worth computing once, added to the table; ``metrics`` are aggregates over it;
    ``fields``, ``passed``, ``score``, ``basis`` and ``present`` refer to the metrics by name. ``basis`` is what the
    dimension's overall check averages (default the score); ``present`` drops the check at run time, for example when a
    column holds no values. ``derived`` columns join the metrics after the aggregation.
    """

    dimension: str
    name: str
    metrics: Mapping[str, str]
    fields: Mapping[str, str]
    passed: str
    score: str
    threshold: float
    present: str
    column: str | None = None
    basis: str | None = None
    inputs: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, Column] = field(default_factory=dict)

    def result(self) -> dict[str, str]:
        return {"passed": self.passed, "score": self.score, "threshold": sql.double(self.threshold)}

    def flag(self) -> dict[str, str]:
        return {"_present": f"coalesce({self.present}, false)"}


def chunks(checks: Sequence[Check]) -> list[list[Check]]:
    parts: list[list[Check]] = [[]]
    names: set[str] = set()
    for check in checks:
        if parts[-1] and len(names | set(check.metrics)) > MAX_AGGREGATES:
            parts.append([])
            names = set()
        parts[-1].append(check)
        names |= set(check.metrics)
    return [p for p in parts if p]


def aggregated(df: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """One row: the aggregates by name. More than fit one aggregation are joined as scalar subqueries, each its own scan."""
    named = list(metrics.items())
    parts = [named[at : at + MAX_AGGREGATES] for at in range(0, len(named), MAX_AGGREGATES)] or [[]]
    rows = [df.selectExpr(*[sql.alias(expression, name) for name, expression in part]) for part in parts]
    if len(rows) == 1:
        return rows[0]
    further = {f"_part{k}": row.select(F.struct("*").alias("s")).scalar() for k, row in enumerate(rows[1:], 1)}
    out = [sql.name(name) for name, _ in parts[0]]
    out += [sql.alias(f"_part{k}.{sql.name(name)}", name) for k, part in enumerate(parts[1:], 1) for name, _ in part]
    return rows[0].withColumns(further).selectExpr(*out)


def per_column(df: DataFrame, cells: Sequence[tuple[Mapping[str, str], str]]) -> DataFrame:
    """One row per cell, a struct over its own aggregates. Each scan takes as many cells as fit one aggregation."""
    parts: list[tuple[dict[str, str], list[str]]] = [({}, [])]
    for metrics, struct in cells:
        if parts[-1][1] and len({**parts[-1][0], **metrics}) > MAX_AGGREGATES:
            parts.append(({}, []))
        parts[-1][0].update(metrics)
        parts[-1][1].append(struct)
    rows = [aggregated(df, metrics).selectExpr(sql.inline(structs)) for metrics, structs in parts]
    return reduce(DataFrame.union, rows)


def _with_derived(row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    derived = {name: column for check in checks for name, column in check.derived.items()}
    return row.withColumns(derived) if derived else row


def measure(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row holding every metric of the checks, then the values derived from them."""
    inputs = {name: expression for check in checks for name, expression in check.inputs.items()}
    if inputs:
        df = df.selectExpr("*", *[sql.alias(expression, name) for name, expression in inputs.items()])
    return _with_derived(aggregated(df, {name: e for check in checks for name, e in check.metrics.items()}), checks)


def _unfolded(row: DataFrame, checks: Sequence[Check], fields) -> DataFrame:
    found = row.selectExpr(sql.inline([sql.struct(fields(check) | check.flag()) for check in checks]))
    return found.filter("_present").drop("_present")


def _unfold(df: DataFrame, checks: Sequence[Check], fields) -> DataFrame:
    return reduce(DataFrame.unionByName, [_unfolded(measure(df, part), part, fields) for part in chunks(checks)])


def flat(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Typed result columns of one check family: its fields, then passed, score and threshold."""
    if not checks:
        raise ValueError("none of the configured columns exist in this table")
    return _unfold(df, checks, lambda check: {**check.fields, **check.result()})


def check_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The checks in the common schema: dimension, check, column, passed, score, threshold, details, basis."""
    return _unfold(df, checks, _common)


def measured_rows(row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """As ``check_rows``, from a row that holds the metrics already."""
    return _unfolded(_with_derived(row, checks), checks, _common)


def _common(check: Check) -> dict[str, str]:
    return {
        "dimension": sql.string(check.dimension),
        "check": sql.string(check.name),
        "column": sql.string(check.column),
        **check.result(),
        "details": f"to_json({sql.struct(dict(check.fields))})",
        "basis": f"CAST({check.basis or check.score} AS DOUBLE)",
    }


def _overall_score(dimension: str, mean: str) -> str:
    """Overall score of a dimension from the mean basis of its checks (null if it has none)."""
    if dimension == "completeness":
        return f"greatest(0D, 1D - coalesce({mean}, 0D))"
    if dimension == "uniqueness":
        return f"greatest(0D, 1D - coalesce({mean}, 0D) * 2)"
    return f"coalesce({mean}, 1D)"


def overall_minimum(dimension: str, limits: Thresholds) -> float:
    return float(
        {
            "completeness": limits.min_completeness,
            "uniqueness": limits.min_uniqueness,
            "validity": limits.min_validity,
            "consistency": limits.min_consistency,
            "timeliness": limits.min_timeliness,
            "accuracy": limits.min_accuracy,
        }[dimension]
    )


def overall(rows: DataFrame, dimension: str, limits: Thresholds) -> DataFrame:
    """The overall check of one dimension from its check rows."""
    minimum = sql.double(overall_minimum(dimension, limits))
    total = rows.filter(f"dimension = {sql.string(dimension)}").selectExpr(
        "count(*) AS checks_aggregated", "avg(basis) AS average"
    )
    return total.selectExpr("*", f"{_overall_score(dimension, 'average')} AS score").selectExpr(
        f"'overall_{dimension}' AS check",
        "checks_aggregated",
        "average",
        "score",
        f"score >= {minimum} AS passed",
        f"{minimum} AS threshold",
    )


def with_overalls(rows: DataFrame, dimensions: Sequence[str], limits: Thresholds) -> DataFrame:
    """Check rows plus one overall row per dimension, from a single evaluation of ``rows``.

    The rows are gathered into one array: there are as many as configured checks, whatever the table's size.
    """
    columns = ("dimension", "check", "column", "passed", "score", "threshold", "details", "basis")
    gathered = rows.selectExpr(f"collect_list(struct({', '.join(columns)})) AS rows")
    means = gathered.selectExpr("rows", *[f"filter(rows, r -> r.dimension = '{d}') AS {d}" for d in dimensions])
    means = means.selectExpr(
        "rows",
        *[
            f"named_struct('n', size({d}), 'mean', CASE WHEN size({d}) > 0 "
            f"THEN aggregate({d}, 0D, (total, r) -> total + r.basis) / size({d}) END) AS {d}"
            for d in dimensions
        ],
    )
    extra = []
    for d in dimensions:
        score, minimum = _overall_score(d, f"{d}.mean"), sql.double(overall_minimum(d, limits))
        values = {
            "dimension": f"'{d}'",
            "check": f"'overall_{d}'",
            "column": sql.string(None),
            "passed": f"{score} >= {minimum}",
            "score": score,
            "threshold": minimum,
            "details": f"to_json(named_struct('checks_aggregated', {d}.n, 'average', {d}.mean))",
            "basis": sql.double(None),
        }
        extra.append(sql.struct(values))
    empty_table = "exists(rows, r -> r.dimension = 'pipeline')"
    return means.selectExpr(
        f"inline(CASE WHEN {empty_table} THEN rows ELSE concat(rows, array({', '.join(extra)})) END)"
    )
