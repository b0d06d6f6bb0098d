"""Drift of a stream of closed windows: each point against the few points before it, which are all the state there is."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from plumbline.config import EPSILON
from plumbline.functions import sqltext as sql
from plumbline.operators.drift import SIGMA, WINDOW

POINT = "metric string, kind string, snapshot timestamp, value double, rolling_mean double, rolling_std double, z_score double, alert boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = datetime(1970, 1, 1)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Stateful processors need this store; a stream keeps the one it was started with, the session its own setting."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class TrailingWindow(StatefulProcessor):
    """Per metric a ring of its last values, nulls included, and the time of the last one."""

    def __init__(self, window: int, sigma: float, gap: timedelta | None):
        self.window, self.sigma, self.gap = window, sigma, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "values array<double>, last timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        values, last = self.ring.get() if self.ring.exists() else ([], None)
        values = [math.nan if v is None else v for v in values]
        found = []
        # windows that close together come in no order
        for row in pd.concat(list(rows)).sort_values("snapshot", kind="stable").itertuples():
            value = math.nan if row.value is None else float(row.value)
            mean = std = z = math.nan
            if len(values) == self.window and not any(map(math.isnan, values)):
                mean = sum(values) / self.window
                std = max(math.sqrt(sum((v - mean) ** 2 for v in values) / self.window), EPSILON)
                z = (value - mean) / std
            found.append((key[0], "point", row.snapshot, value, mean, std, z, abs(z) > self.sigma))
            values = [*values, value][-self.window :]
            last = row.snapshot
        last = pd.Timestamp(last).to_pydatetime().replace(tzinfo=None)
        self.ring.update((values, last))
        if self.gap is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(_milliseconds(last + self.gap))
        yield _frame(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, last = self.ring.get()
        yield _frame([(key[0], "gap", pd.Timestamp(last), *[math.nan] * 4, True)])

    def close(self) -> None:
        pass


def _milliseconds(moment: datetime) -> int:
    return (moment - _EPOCH) // timedelta(milliseconds=1)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in POINT.split(", ")])
    numbers = ["value", "rolling_mean", "rolling_std", "z_score"]
    return frame.astype({c: object for c in numbers}).where(frame.notna(), None)


def series_of(windows: DataFrame, time: str = "window_start") -> DataFrame:
    """Long form (metric, snapshot, value) of a stream of windows, without losing the time's watermark."""
    names = [c for c in windows.columns if c != time]
    cells = [sql.struct({"metric": sql.string(c), "value": f"CAST({sql.name(c)} AS DOUBLE)"}) for c in names]
    return windows.selectExpr(f"{sql.name(time)} AS snapshot", sql.inline(cells))


def drift_points(series: DataFrame, window: int = WINDOW, sigma: float = SIGMA, gap: str | None = None) -> DataFrame:
    """Every point of a stream (metric, snapshot, value) with mean and deviation of the ``window`` points before it.

    The rules are those of ``operators.drift``: a missing value leaves the score null for itself and while it is in the
    window. Points of a metric have to arrive in order of time, as closed windows do; state is one ring of values per
    metric, and no stored window is read again. With a ``gap`` (as "2 days") a metric from which nothing came for so long
    gives one row of kind "gap", with the time of its last point; the series then needs a watermark. Start the stream
    inside ``rocksdb_state``.
    """
    wait = pd.Timedelta(gap).to_pytimedelta() if gap else None
    processor = TrailingWindow(window, sigma, wait)
    return series.groupBy("metric").transformWithStateInPandas(processor, POINT, "Append", "EventTime" if gap else "None")


def events_of(points: DataFrame) -> DataFrame:
    """The alerts among the points, in the form of ``operators.drift.drift_events``."""
    return points.where(F.col("alert") & (F.col("kind") == "point")).drop("alert", "kind")
