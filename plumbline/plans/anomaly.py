"""The anomaly report: univariate outliers, drift and the isolation forest as one frame of check rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from plumbline.functions.columns import nan_to_null, numeric_columns, selected
from plumbline.functions.lineage import kept
from plumbline.operators import checks, drift, forest, outliers
from plumbline.operators.scoring import finished
from plumbline.plans.quality import empty_table_check

_COLUMNS = ("dimension", "check", "column", "passed", "score", "threshold", "details")


def anomaly_checks(
    df: DataFrame,
    dataset: str = "table",
    series: DataFrame | None = None,
    with_forest: bool = True,
    key: Sequence[str] | None = None,
    iqr_factor: float = 1.5,
    z_limit: float = 3.0,
    drift_window: int = drift.WINDOW,
    drift_sigma: float = drift.SIGMA,
    contamination: float = forest.CONTAMINATION,
    detectors: Sequence[Callable[[DataFrame], DataFrame]] = (),
    as_of=None,
    detector_columns: Sequence[str] | None = None,
    stored: bool = False,
) -> DataFrame:
    """Every anomaly check of ``df`` in ``CHECK_SCHEMA``.

    ``series`` are snapshot metrics (metric, snapshot, value) for the drift checks; ``detectors`` are further functions
    from the table to check rows. Outliers of all columns and methods are counted in one scan. What these checks read of
    ``df`` is kept once, so that its plan runs once for them, and once more for each detector. Where ``detector_columns``
    name all columns that the detectors read, these are kept too and are the table they get, so that the plan runs once.
    Nothing is kept of a table that is ``stored`` anyway.
    """
    df = nan_to_null(df)
    numeric, wanted = set(numeric_columns(df)), set(key or ()) if with_forest else set()
    wanted |= set(detector_columns or ())
    read = [c for c in df.columns if c in numeric or c in wanted]
    narrow = df if not numeric else selected(df, read) if stored else kept(df, read, "measured")
    bounds = outliers.fit(narrow, iqr_factor=iqr_factor, z_limit=z_limit, stored=True)
    parts = [checks.check_rows(narrow, [empty_table_check(), *outliers.outlier_checks(bounds)]).select(*_COLUMNS)]
    if not bounds and narrow.isEmpty():
        return finished(parts[0], dataset, as_of)
    if series is not None:
        parts.append(drift.check_rows(series, drift_window, drift_sigma).select(*_COLUMNS))
    if with_forest:
        forest_rows = forest.check_rows(narrow, key, contamination=contamination, stored=True)
        if forest_rows is not None:
            parts.append(forest_rows.select(*_COLUMNS))
    seen = df if detector_columns is None else selected(narrow, detector_columns)
    parts += [detector(seen).select(*_COLUMNS) for detector in detectors]
    return finished(reduce(DataFrame.unionByName, parts), dataset, as_of)
