"""Quantile sketches of numeric columns that are kept per snapshot and merged for any range of snapshots.

A KLL sketch of size ``k`` holds a few thousand values, whatever the table's size, and merging two of them loses nothing
beyond the error of one. A new snapshot therefore costs one scan of itself; quantiles and outlier rates of any range of
snapshots follow from the stored sketches. ``rank_error`` states how far a sketch's ranks may be off.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import RATE_PASS, RATE_ZERO_SCORE
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, numeric_columns, selected
from plumbline.operators.checks import aggregated
from plumbline.operators.quantiles import SKETCH_SIZE, Summary, exact_from, grid_of, rank_error, sketch_of

#: Columns of the stored form, besides the partition column ``snapshot``.
STATE = ("column", "sketch", "values", "least", "greatest")


def snapshot_sketches(df: DataFrame, columns: Sequence[str] | None = None, snapshot: str = "day", size: int = SKETCH_SIZE) -> DataFrame:
    """(snapshot, column, sketch, values, least, greatest), from one scan: tasks send one sketch per snapshot and column.

    Missing values take no part; a column without values in a snapshot has a null sketch.
    """
    columns = [c for c in (numeric_columns(df) if columns is None else columns) if c != snapshot]
    df = nan_to_null(selected(df, [snapshot, *columns]))
    sums = []
    for i, c in enumerate(columns):
        value = sql.as_double(c)
        sums += [f"{sketch_of(value, size)} AS s{i}", f"count({value}) AS n{i}", f"min({value}) AS l{i}", f"max({value}) AS g{i}"]
    grouped = df.groupBy(F.expr(f"{sql.name(snapshot)} AS snapshot")).agg(*map(F.expr, sums))
    cells = [
        sql.struct({"column": sql.string(c), "sketch": f"CASE WHEN n{i} > 0 THEN s{i} END", "values": f"n{i}", "least": f"l{i}", "greatest": f"g{i}"})
        for i, c in enumerate(columns)
    ]
    return grouped.selectExpr("snapshot", sql.inline(cells))


def store(sketches: DataFrame, path: str) -> None:
    """Keep the sketches of snapshots under ``path``; snapshots stored before are replaced, all others stay."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("snapshot").parquet(path)


def load(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Stored sketches of the snapshots from ``first`` to ``last``; files of other snapshots are not opened."""
    found = spark.read.parquet(path)
    if first is not None:
        found = found.where(F.col("snapshot") >= F.lit(first))
    return found if last is None else found.where(F.col("snapshot") <= F.lit(last))


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column over all given snapshots: sketch, values, least, greatest. Columns without values have none."""
    return (
        sketches.where("sketch IS NOT NULL")
        .groupBy("column")
        .agg(*map(F.expr, ("kll_merge_agg_double(sketch) AS sketch", "sum(values) AS values", "min(least) AS least", "max(greatest) AS greatest")))
    )


def quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(column, values, quantiles) of the merged sketches: values whose rank is within ``rank_error`` of the wanted one."""
    points = f"array({', '.join(sql.double(p) for p in probabilities)})"
    return merged(sketches).selectExpr("column", "values", f"kll_sketch_get_quantile_double(sketch, {points}) AS quantiles")


def iqr_outliers(sketches: DataFrame, factor: float = 1.5, size: int = SKETCH_SIZE) -> DataFrame:
    """Outlier rate per column by the interquartile range, from sketches alone: no row of the table is read again.

    The quartiles are values of a rank within ``rank_error``, and so is the share of values outside the bounds (by twice
    that at most). Columns without spread between the quartiles, or with fewer than four values, give no row.
    """
    quartiles = merged(sketches).selectExpr("*", "kll_sketch_get_quantile_double(sketch, array(0.25D, 0.75D)) AS q").where("values >= 4 AND q[1] > q[0]")
    bounds = {r["column"]: (r["q"][0] - factor * (r["q"][1] - r["q"][0]), r["q"][1] + factor * (r["q"][1] - r["q"][0])) for r in quartiles.select("column", "q").collect()}
    low, high = (_by_column({c: sql.double(b[i]) for c, b in bounds.items()}) for i in (0, 1))
    outside = _by_column({c: f"{_below(b[0])} + {_above(b[1])}" for c, b in bounds.items()})
    rows = quartiles.selectExpr("*", f"{low} AS lower_bound", f"{high} AS upper_bound", f"{outside} AS outlier_rate")
    observed = "outlier_rate"
    return rows.selectExpr(
        "column",
        "values AS values_checked",
        "q[0] AS q1",
        "q[1] AS q3",
        "q[1] - q[0] AS iqr",
        "lower_bound",
        "upper_bound",
        observed,
        f"{sql.double(rank_error(size))} AS rank_error",
        f"{observed} <= {sql.double(RATE_PASS)} AS passed",
        f"{sql.penalty(observed, RATE_ZERO_SCORE)} AS score",
        f"{sql.double(RATE_PASS)} AS threshold",
    )


def _by_column(by_column: Mapping[str, str]) -> str:
    cases = " ".join(f"WHEN {sql.string(c)} THEN {text}" for c, text in by_column.items())
    return f"CASE column {cases} END" if cases else sql.double(None)


def _below(bound: float) -> str:
    """The share of values under a bound; a sketch's rank counts equal values, hence the next smaller number."""
    before = sql.double(math.nextafter(bound, -math.inf))
    return f"CASE WHEN least >= {sql.double(bound)} THEN 0D ELSE kll_sketch_get_rank_double(sketch, {before}) END"


def _above(bound: float) -> str:
    return f"CASE WHEN greatest <= {sql.double(bound)} THEN 0D ELSE 1D - kll_sketch_get_rank_double(sketch, {sql.double(bound)}) END"


def exact_quantiles(df: DataFrame, sketches: DataFrame, probabilities: Sequence[float]) -> dict[str, list[float] | None]:
    """Exact quantiles of the table that the sketches describe, interpolated linearly between neighbouring ranks.

    The sketches say where to look, so one scan of ``df`` is enough as long as the rows in question are few; if a sketch
    is further off than stated, another scan follows.
    """
    rows = merged(sketches).selectExpr("column", "values", "least", "greatest", f"{grid_of('sketch')} AS grid").collect()
    known = {r["column"]: Summary(r["values"], r["least"], r["greatest"], r["grid"]) for r in rows}
    return exact_from(nan_to_null(selected(df, known)), {c: sql.as_double(c) for c in known}, probabilities, known)


def verified(df: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``iqr_outliers`` beside what one scan of the table itself says of them.

    ``q1_rank_off`` and ``q3_rank_off`` are the distances of the quartiles' true ranks from the wanted ones (0 if the wanted
    rank falls among values equal to the quartile), ``actual_rate`` the share of values outside the bounds.
    """
    rows = {r["column"]: r for r in found.select("column", "q1", "q3", "lower_bound", "upper_bound").collect()}
    metrics, cells = {}, []
    for i, (c, r) in enumerate(rows.items()):
        value = sql.as_double(c)
        metrics[f"n{i}"] = f"count({value})"
        metrics[f"o{i}"] = sql.count_true(f"{value} < {sql.double(r['lower_bound'])} OR {value} > {sql.double(r['upper_bound'])}")
        off = {}
        for q, wanted in (("q1", 0.25), ("q3", 0.75)):
            metrics |= {f"{q}b{i}": sql.count_true(f"{value} < {sql.double(r[q])}"), f"{q}t{i}": sql.count_true(f"{value} <= {sql.double(r[q])}")}
            below, through = (f"(CAST({q}{x}{i} AS DOUBLE) / n{i})" for x in "bt")
            off[f"{q}_rank_off"] = f"greatest(0D, {below} - {sql.double(wanted)}, {sql.double(wanted)} - {through})"
        cells.append(sql.struct({"column": sql.string(c), **off, "actual_rate": sql.rate(f"o{i}", f"n{i}")}))
    if not cells:
        return found.selectExpr("*", *[f"{sql.double(None)} AS {c}" for c in ("q1_rank_off", "q3_rank_off", "actual_rate")])
    measured = aggregated(nan_to_null(selected(df, rows)), metrics).selectExpr(sql.inline(cells))
    return found.join(measured, "column")


def quantile_rows(df: DataFrame, sketches: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """``exact_quantiles`` as rows: column and one double per named probability, null for a column without values."""
    names = sorted(r["column"] for r in sketches.select("column").distinct().collect())
    found = exact_quantiles(df, sketches, list(probabilities.values()))
    rows = [(c, *(found[c] if found.get(c) else [None] * len(probabilities))) for c in names]
    return df.sparkSession.createDataFrame(rows, f"column string, {', '.join(f'{sql.name(p)} double' for p in probabilities)}")
