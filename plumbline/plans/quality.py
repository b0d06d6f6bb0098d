"""The quality report: all dimensions of a table as one frame of check rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from plumbline.config import Roles, Thresholds
from plumbline.functions.columns import nan_to_null
from plumbline.operators import accuracy, checks, completeness, consistency, custom, timeliness, uniqueness, validity
from plumbline.operators.checks import Check
from plumbline.operators.scoring import CHECK_SCHEMA, finished


def empty_table_check() -> Check:
    """Fails, as the only check, when the table has no rows."""
    return Check(
        dimension="pipeline",
        name="empty_dataset",
        metrics={"rows": "count(*)"},
        fields={"error": "'input has no rows'"},
        passed="false",
        score="0D",
        threshold=0.0,
        present="rows = 0",
    )


def missing_table_checks(spark: SparkSession, dataset: str, as_of=None) -> DataFrame:
    """What an absent table yields: the same failed check as an empty one."""
    absent = spark.range(0).selectExpr("id AS value")
    return finished(checks.check_rows(absent, [empty_table_check()]), dataset, as_of)


def quality_checks(
    df: DataFrame,
    dataset: str = "table",
    reference: DataFrame | None = None,
    known: DataFrame | None = None,
    truth: DataFrame | None = None,
    limits: Thresholds = Thresholds(),
    roles: Roles = Roles(),
    rules: Sequence[custom.Predicate] = (),
    as_of=None,
) -> DataFrame:
    """Every quality check of ``df`` in ``CHECK_SCHEMA``.

    ``reference`` holds the valid keys, ``known`` the lookup (key, value), ``truth`` a trusted copy; checks without
    their input are left out. All checks that need no grouping share one scan; row duplicates, key duplicates,
    references and lookups add one grouped pass each.
    """
    df = nan_to_null(df)
    single_pass = [
        empty_table_check(),
        *completeness.null_rate_checks(df, limits),
        *validity.validity_checks(df, limits, roles, as_of),
        *consistency.arithmetic_checks(df, roles),
        *timeliness.timeliness_checks(df, limits, roles, as_of),
        *custom.predicate_checks(rules),
    ]
    dimensions = list(checks.DIMENSIONS[:-1])
    if truth is not None:
        single_pass += accuracy.distribution_checks(df, truth)
        dimensions.append("accuracy")
    parts = [
        checks.check_rows(df, single_pass),
        uniqueness.check_rows(df, limits, roles),
        *consistency.aggregated_rows(df, limits, roles, reference, known),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return finished(checks.with_overalls(rows, dimensions, limits), dataset, as_of)


__all__ = ["CHECK_SCHEMA", "empty_table_check", "missing_table_checks", "quality_checks"]
