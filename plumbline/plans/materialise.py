"""Writing a table and checking it in one pass: the checks' aggregates are observed while the rows go by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plumbline.config import Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.operators import accuracy, checks, completeness, consistency, custom, timeliness, validity
from plumbline.operators.scoring import finished
from plumbline.plans.quality import empty_table_check


def write_checked(
    df: DataFrame,
    path: str,
    dataset: str = "table",
    truth: DataFrame | None = None,
    limits: Thresholds = Thresholds(),
    roles: Roles = Roles(),
    rules: Sequence[custom.Predicate] = (),
    as_of=None,
    kind: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` under ``path`` and return its checks in ``CHECK_SCHEMA``, from the same single scan.

    These are the checks of ``quality_checks`` that need no grouping or other table (``truth`` may be given, as its side is
    one row): completeness, formats, dates, ranges, arithmetic, timeliness, accuracy and predicates, without the overall
    rows. The table is written as it is: what the checks take as missing, such as NaN, stays.
    """
    whole, clean = F.struct(*[F.col(sql.name(c)) for c in df.columns]).alias("_row"), nan_to_null(df)
    found = [
        empty_table_check(),
        *completeness.null_rate_checks(clean, limits),
        *validity.validity_checks(clean, limits, roles, as_of),
        *consistency.arithmetic_checks(clean, roles),
        *timeliness.timeliness_checks(clean, limits, roles, as_of),
        *custom.predicate_checks(rules),
        *(accuracy.distribution_checks(clean, truth) if truth is not None else []),
    ]
    watched = nan_to_null(df.select("*", whole))
    inputs = {name: expression for check in found for name, expression in check.inputs.items()}
    watched = watched.selectExpr("*", *[sql.alias(expression, name) for name, expression in inputs.items()])
    parts = checks.chunks(found)
    metrics = [{name: e for check in part for name, e in check.metrics.items()} for part in parts]
    schemas = [watched.selectExpr(*[sql.alias(e, name) for name, e in m.items()]).schema for m in metrics]
    observed = [Observation() for _ in metrics]
    for observation, m in zip(observed, metrics, strict=True):
        watched = watched.observe(observation, *[F.expr(sql.alias(e, name)) for name, e in m.items()])
    writer = watched.select("_row.*").write.format(kind).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    rows = None
    for observation, part, schema in zip(observed, parts, schemas, strict=True):
        values = observation.get
        row = df.sparkSession.createDataFrame([tuple(values[f.name] for f in schema.fields)], schema)
        unfolded = checks.measured_rows(row, part)
        rows = unfolded if rows is None else rows.unionByName(unfolded)
    return finished(rows, dataset, as_of)
