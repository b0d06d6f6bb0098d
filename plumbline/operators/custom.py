"""Checks given as SQL predicates, folded into the same aggregation as the built-in ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check


@dataclass(frozen=True)
class Predicate:
    """A row predicate and the share of rows that must satisfy it; a null outcome counts as not satisfied."""

    dimension: str
    name: str
    expression: str
    min_rate: float = 0.95
    where: str | None = None


def predicate_checks(rules: Sequence[Predicate]) -> list[Check]:
    found = []
    for rule in rules:
        scope = f"({rule.where or 'true'})"
        checked, satisfied = sql.name(f"in scope of {rule.name}"), sql.name(f"satisfied {rule.name}")
        observed = sql.rate(satisfied, checked)
        found.append(
            Check(
                dimension=rule.dimension,
                name=rule.name,
                metrics={
                    f"in scope of {rule.name}": sql.count_true(scope),
                    f"satisfied {rule.name}": sql.count_true(f"{scope} AND ({rule.expression})"),
                },
                fields={
                    "check": sql.string(rule.name),
                    "rows_checked": checked,
                    "satisfied": satisfied,
                    "satisfied_rate": observed,
                },
                passed=f"{observed} >= {sql.double(rule.min_rate)}",
                score=sql.attainment(observed, rule.min_rate),
                threshold=rule.min_rate,
                present=f"{checked} > 0",
            )
        )
    return found


def predicates(df: DataFrame, rules: Sequence[Predicate]) -> DataFrame:
    return fused.flat(nan_to_null(df), predicate_checks(rules))
