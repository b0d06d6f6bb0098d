"""Continuous checking: every micro-batch of a stream is checked and its results are stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators import scoring
from plumbline.streaming.drift import drift_points, events_of, rocksdb_state, series_of


def monitor(
    stream: DataFrame,
    checks_of: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Check each micro-batch with ``checks_of`` (table to check rows) and store checks and report under ``path``.

    Every batch owns the folder ``batch_id=n``; a batch repeated after a failure overwrites its own output. The
    checks are evaluated once: the report is read off the stored rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/checks/batch_id={batch_id}"
        batch.persist()  # every family of checks reads it
        try:
            checks = checks_of(batch)
            checks.write.mode("overwrite").parquet(folder)
        finally:
            batch.unpersist()
        stored = batch.sparkSession.read.schema(checks.schema).parquet(folder)
        scoring.report(stored).write.mode("overwrite").parquet(f"{path}/reports/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def watch_drift(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    window: int = 5,
    sigma: float = 2.0,
    available_now: bool = True,
) -> StreamingQuery:
    """Store closed windows (as ``windowed_metrics`` emits them) and the drift events among them.

    The few points before each window are kept as state of the stream, so that no stored window is read again; every batch
    writes its own windows and events, and a batch repeated after a failure overwrites them.
    """
    metrics = [c for c in windows.columns if c != "window_start"]
    points = drift_points(series_of(windows), window, sigma)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            closed = batch.groupBy(F.col("snapshot").alias("window_start")).pivot("metric", metrics).agg(F.first("value"))
            closed.write.mode("overwrite").parquet(f"{path}/windows/batch_id={batch_id}")
            events_of(batch).write.mode("overwrite").parquet(f"{path}/drift_events/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = points.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
    with rocksdb_state(windows.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
