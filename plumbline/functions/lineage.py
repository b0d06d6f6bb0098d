"""Storing intermediate frames so that they are computed once and survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from plumbline.functions import sqltext as sql

# Spark then deletes the shuffle files of a statement at its end instead of when the driver collects garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a session on one machine that names none gets a local one, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="plumbline-checkpoint-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the checkpoint folder; later reads do not repeat its plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements inside leave no shuffle files behind; the session's setting is restored."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def written(df: DataFrame, name: str = "table", codec: str = "snappy") -> DataFrame:
    """``df`` computed now and kept as Parquet in the checkpoint folder: compressed, and read by column.

    What was shuffled for it is deleted, as later reads need the files only.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with _shuffles_dropped(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, columns: Sequence[str] | None = None, name: str = "kept") -> DataFrame:
    """Some columns of ``df`` (all, if none are named), computed now and kept as by ``written``.

    For what is read several times: joins and shuffles behind ``df`` then run once. Columns of a type that Parquet cannot
    hold, and no columns at all, are left as they are.
    """
    if columns is not None:
        df = df.selectExpr(*[sql.name(c) for c in columns])
    if not df.columns or any(kind in f.dataType.simpleString() for f in df.schema.fields for kind in ("void", "interval")):
        return df
    # neutral names, since files may not hold every name
    return written(df.toDF(*[f"c{i}" for i in range(len(df.columns))]), name).toDF(*df.columns)


def scratch(spark: SparkSession, name: str = "table") -> str:
    """The path of a new folder in the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
