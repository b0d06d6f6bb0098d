"""Univariate outliers of numeric columns: interquartile range, z-score and modified z-score.

``fit`` summarises the table into two bounds per column and method; the bounds then are literals in an ordinary filter
or aggregation, so flagging a table needs neither a join nor a second table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.config import RATE_PASS, RATE_ZERO_SCORE
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, numeric_columns, selected
from plumbline.functions.lineage import kept
from plumbline.operators import checks as fused
from plumbline.operators.checks import Check
from plumbline.operators.quantiles import exact_from, exact_quantiles_of, summaries, summary_columns, summary_metrics

METHODS = ("iqr", "zscore", "modified_zscore")
MAD_SCALE = 0.6745
MIN_VALUES = 4
# Columns fitted in one sequence of scans; six aggregates each.
COLUMNS_AT_ONCE = 20


@dataclass(frozen=True)
class Bounds:
    """What counts as an outlier of one column under one method."""

    column: str
    method: str
    center: float
    scale: float
    limit: float

    @property
    def dimension(self) -> str:
        return "anomaly_iqr" if self.method == "iqr" else "anomaly_zscore"

    @property
    def check(self) -> str:
        return f"iqr_outliers_{self.column}" if self.method == "iqr" else f"{self.method}_{self.column}"

    @property
    def lower(self) -> float:
        """Quartile bounds (IQR only): ``center`` is the lower quartile, ``scale`` the range between the quartiles."""
        return self.center - self.limit * self.scale

    @property
    def upper(self) -> float:
        return self.center + self.scale + self.limit * self.scale

    @property
    def factor(self) -> float:
        return MAD_SCALE if self.method == "modified_zscore" else 1.0

    def exceeds(self) -> str:
        """Condition for an outlier; null for a null value."""
        value = sql.as_double(self.column)
        if self.method == "iqr":
            return f"({value} < {sql.double(self.lower)} OR {value} > {sql.double(self.upper)})"
        return f"({self.severity()} > {sql.double(self.limit)})"

    def severity(self) -> str:
        """Distance from the middle in units of the scale: |z| for the z methods."""
        middle = self.center + self.scale / 2 if self.method == "iqr" else self.center
        distance = f"({sql.as_double(self.column)} - {sql.double(middle)})"
        return f"abs({sql.double(self.factor)} * {distance} / {sql.double(self.scale)})"


def measured(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The numeric columns of ``df`` (or those named), kept once for fitting, counting and sampling their outliers."""
    return kept(nan_to_null(selected(df, numeric_columns(df) if columns is None else columns)), name="measured")


def _summarised(df: DataFrame, values: dict[str, str], moments: bool, quartiles: bool):
    """Mean and sample deviation, and summaries for quantiles, of some columns from one scan."""
    metrics = {}
    for i, value in enumerate(values.values() if moments else ()):
        metrics |= {f"_mean{i}": f"avg({value})", f"_std{i}": f"stddev_samp({value})"}
    metrics |= summary_metrics(values) if quartiles else {}
    row = df.selectExpr(*[sql.alias(expression, name) for name, expression in metrics.items()])
    found = row.selectExpr(*[c for c in metrics if c.startswith(("_mean", "_std"))], *(summary_columns(values) if quartiles else [])).first()
    means = {c: (found[f"_mean{i}"], found[f"_std{i}"]) for i, c in enumerate(values)} if moments else {}
    return means, summaries(found, values) if quartiles else {}


def fit(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    methods: Sequence[str] = METHODS,
    iqr_factor: float = 1.5,
    z_limit: float = 3.0,
    stored: bool = False,
) -> list[Bounds]:
    """Bounds per column and method; columns without values or without spread are left out.

    One scan gives the moments and sketches of all columns, a second one the exact quartiles, a third one the median
    distances for the modified z-score, of which the sketches say where to look. Wide tables are fitted in parts. The
    columns are kept once for these scans, unless ``df`` is ``stored`` anyway (as by ``measured``).
    """
    if unknown := set(methods) - set(METHODS):
        raise ValueError(f"unknown methods {sorted(unknown)}; known: {METHODS}")
    columns = list(numeric_columns(df) if columns is None else columns)
    df = nan_to_null(selected(df, columns))
    df = df if stored or set(methods) == {"zscore"} else kept(df, name="measured")
    found: dict[str, dict[str, tuple[float | None, float | None]]] = {m: {} for m in methods}
    for at in range(0, len(columns), COLUMNS_AT_ONCE):
        values = {c: sql.as_double(c) for c in columns[at : at + COLUMNS_AT_ONCE]}
        means, known = _summarised(df, values, "zscore" in methods, bool({"iqr", "modified_zscore"} & set(methods)))
        known = {c: s for c, s in known.items() if s is not None}
        quartiles = exact_from(df, {c: values[c] for c in known}, (0.25, 0.5, 0.75), known)
        if "zscore" in methods:
            found["zscore"] |= means
        if "iqr" in methods:
            found["iqr"] |= {c: (q1, q3 - q1) for c, (q1, _, q3) in quartiles.items()}
        if "modified_zscore" in methods:
            distances = {c: f"abs({values[c]} - {sql.double(quartiles[c][1])})" for c in known}
            near = {c: [known[c].distances(quartiles[c][1], 0.5)] for c in known}
            deviations = exact_from(df, distances, (0.5,), known, near)
            found["modified_zscore"] |= {c: (quartiles[c][1], deviations[c][0]) for c in known}
    return [
        Bounds(c, method, center, scale, iqr_factor if method == "iqr" else z_limit)
        for method in methods
        for c, (center, scale) in found[method].items()
        if scale and math.isfinite(scale)
    ]


def or_none(
    df: DataFrame, bounds: Sequence[Bounds], columns: Sequence[str] | None, methods: Sequence[str]
) -> tuple[list[Bounds], bool]:
    """The bounds; where no column has any, a stand-in that gives the result's columns, and False."""
    names = list(numeric_columns(df) if columns is None else columns)
    if bounds or not names:
        return list(bounds), True
    return [Bounds(names[0], methods[0], 0.0, 1.0, 1.0)], False


def outlier_checks(bounds: Sequence[Bounds]) -> list[Check]:
    """Outlier counts of all columns and methods, fused into one aggregation."""
    found = []
    for b in bounds:
        checked, outside = sql.name(f"values of {b.column}"), sql.name(f"{b.method} outliers in {b.column}")
        observed = sql.rate(outside, checked)
        if b.method == "iqr":
            extreme = {}
            described = {
                "q1": sql.double(b.center),
                "q3": sql.double(b.center + b.scale),
                "iqr": sql.double(b.scale),
                "lower_bound": sql.double(b.lower),
                "upper_bound": sql.double(b.upper),
            }
        else:
            extreme = {f"max {b.method} of {b.column}": f"max({b.severity()})"}
            described = {"max_abs_z": sql.name(f"max {b.method} of {b.column}")}
        found.append(
            Check(
                dimension=b.dimension,
                name=b.check,
                column=b.column,
                metrics={
                    f"values of {b.column}": f"count({sql.name(b.column)})",
                    f"{b.method} outliers in {b.column}": sql.count_true(b.exceeds()),
                    **extreme,
                },
                fields={
                    "column": sql.string(b.column),
                    "method": sql.string(b.method),
                    **described,
                    "values_checked": checked,
                    "outlier_count": outside,
                    "outlier_rate": observed,
                },
                passed=f"{observed} <= {sql.double(RATE_PASS)}",
                score=sql.penalty(observed, RATE_ZERO_SCORE),
                threshold=RATE_PASS,
                present=f"{checked} >= {MIN_VALUES}",
            )
        )
    return found


def outliers(df: DataFrame, method: str, columns: Sequence[str] | None = None, **limits) -> DataFrame:
    """Outlier count and rate per numeric column under one method; columns without spread give no row."""
    df = nan_to_null(df)
    if method != "zscore" and (columns or numeric_columns(df)):
        df = measured(df, columns)
    bounds, some = or_none(df, fit(df, columns, (method,), stored=True, **limits), columns, (method,))
    found = fused.flat(df, outlier_checks(bounds))
    return found if some else found.limit(0)


def outlier_rows(df: DataFrame, bounds: Sequence[Bounds], keep: Sequence[str]) -> DataFrame:
    """Every row with the columns ``keep`` and one flag per column and method; null values are never outliers."""
    flags = [sql.alias(f"coalesce({b.exceeds()}, false)", f"{b.method}_{b.column}") for b in bounds]
    return nan_to_null(df).selectExpr(*[sql.name(c) for c in keep], *flags)


def outlier_samples(df: DataFrame, bounds: Sequence[Bounds], k: int = 10) -> DataFrame:
    """The k most extreme outliers per column and method, ties by value.

    The rank limit is applied within each task before the shuffle, so no column's outliers gather in one place.
    """
    cells = []
    for b in bounds:
        fields = {
            "column": sql.string(b.column),
            "method": sql.string(b.method),
            "value": sql.as_double(b.column),
            "severity": b.severity(),
        }
        cells.append(f"CASE WHEN {b.exceeds()} THEN {sql.struct(fields)} END")
    extreme = nan_to_null(df).selectExpr(sql.inline_present(cells))
    order = "row_number() OVER (PARTITION BY column, method ORDER BY severity DESC, value)"
    return extreme.selectExpr("*", f"{order} AS rank").filter(f"rank <= {int(k)}")


def median_impute(df: DataFrame, columns: Sequence[str] | None = None, stored: bool = False) -> DataFrame:
    """Replace missing numeric values by the column's median; the columns become double.

    The columns are kept once for the scans that find the medians, unless ``df`` is ``stored`` anyway.
    """
    columns = list(numeric_columns(df) if columns is None else columns)
    df = nan_to_null(df)
    medians = exact_quantiles_of(df if stored else measured(df, columns), {c: sql.as_double(c) for c in columns}, (0.5,))
    filled = {c for c in columns if medians[c] is not None}
    return df.selectExpr(
        *[
            sql.alias(f"coalesce({sql.as_double(c)}, {sql.double(medians[c][0])})", c) if c in filled else sql.name(c)
            for c in df.columns
        ]
    )
