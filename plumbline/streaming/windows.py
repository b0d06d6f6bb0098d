"""Quality metrics over tumbling windows, on streams and tables alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null


def windowed_metrics(
    df: DataFrame,
    time: str,
    value: str,
    bounds: tuple[float, float],
    width: str = "1 day",
    delay: str | None = None,
    nulls_of: Sequence[str] = (),
) -> DataFrame:
    """Row count, null rates, out-of-range rate and mean of ``value`` per window.

    With a ``delay`` the time gets a watermark, so on a stream each window is emitted once, when no more rows are
    expected, and rows arriving later are dropped. State is one row per open window.
    """
    timed = nan_to_null(df).selectExpr("*", f"CAST({sql.name(time)} AS TIMESTAMP) AS _time")
    if delay is not None:
        timed = timed.withWatermark("_time", delay)
    number = sql.as_double(value)
    low, high = bounds
    metrics = timed.groupBy(F.window("_time", width).alias("window")).agg(
        F.expr("count(*) AS rows"),
        F.expr(f"count({number}) AS values"),
        F.expr(f"count_if({number} < {sql.double(low)} OR {number} > {sql.double(high)}) AS _outside"),
        F.expr(f"avg({number}) AS mean_value"),
        *[F.expr(sql.alias(f"count_if({sql.name(c)} IS NULL)", f"nulls of {c}")) for c in nulls_of],
    )
    return metrics.selectExpr(
        "window.start AS window_start",
        "rows",
        "values",
        f"{sql.rate('_outside', 'values')} AS out_of_range_rate",
        "mean_value",
        *[sql.alias(sql.rate(sql.name(f"nulls of {c}"), "rows"), f"null_rate_{c}") for c in nulls_of],
    )


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within the watermark delay; older keys leave the state."""
    timed = stream.withColumn(time, F.expr(f"CAST({sql.name(time)} AS TIMESTAMP)")).withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))
