"""Keys seen so far: duplicates across snapshots without reading or shuffling the earlier snapshots again.

A store keeps the digest of every distinct key once, with the snapshot it first came in, as a table that is bucketed and
sorted by digest. A new snapshot is reduced to its distinct digests, dealt by the same buckets and merge-joined with the
store; only digests that are new are appended. Beside it stands one row of counts per snapshot, from which duplicates of
any range that begins with the first snapshot follow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null
from plumbline.functions.digest import row_digest

COUNTS = "rows bigint, new_keys bigint, snapshot bigint"


@dataclass(frozen=True)
class SeenKeys:
    """A store under ``path``, known to the session's catalog as ``table``.

    There should be at least as many buckets as shuffle partitions, since Spark prefers its own partitioning to a coarser
    one; a bucket is one task's work when a snapshot is absorbed.
    """

    spark: SparkSession
    table: str
    path: str
    buckets: int = 64

    def attach(self) -> SeenKeys:
        """Make the store known to this session; a new one is empty."""
        columns = "digest BINARY, first_snapshot BIGINT"
        spec = f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(self.buckets)} BUCKETS"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {sql.name(self.table)} ({columns}) USING parquet {spec} LOCATION {sql.string(f'{self.path}/digests')}")
        return self

    def detach(self) -> None:
        """Forget the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {sql.name(self.table)}")

    def digests(self) -> DataFrame:
        return self.spark.read.table(sql.name(self.table))

    def counts(self) -> DataFrame:
        """snapshot, rows and new_keys of every absorbed snapshot."""
        return self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts")

    def first_seen(self, df: DataFrame, keys: Sequence[str], snapshot: str) -> DataFrame:
        """(digest, snapshot, known): each distinct key of ``df`` with its first snapshot there, and whether the store
        holds it from another snapshot. The store's side of the join is read bucket by bucket, without a shuffle."""
        df = nan_to_null(df)
        distinct = df.groupBy(F.expr(row_digest(df, list(keys))).alias("digest")).agg(F.expr(f"min(CAST({sql.name(snapshot)} AS BIGINT)) AS snapshot"))
        held = self.digests().withColumnRenamed("digest", "held")
        joined = distinct.join(held.hint("merge"), F.expr("digest = held"), "left")
        # what the same snapshot stored when it was absorbed before is its own
        return joined.selectExpr("digest", "snapshot", "held IS NOT NULL AS stored", "held IS NOT NULL AND first_snapshot <> snapshot AS known")

    def absorb(self, df: DataFrame, keys: Sequence[str], snapshot: str) -> None:
        """Take in one or more whole snapshots, later than all stored ones or stored before with the same rows.

        New digests are appended first and counted in the store, by the files that hold the snapshots in question, and the
        counts are written last, each snapshot's over its own: absorbing a snapshot again after a failure gives the same.
        """
        key = f"CAST({sql.name(snapshot)} AS BIGINT)"
        rows = {r["snapshot"]: r["rows"] for r in df.groupBy(F.expr(f"{key} AS snapshot")).agg(F.expr("count(*) AS rows")).collect()}
        if not rows:
            return
        new = self.first_seen(df, keys, snapshot).where("NOT stored").selectExpr("digest", "snapshot AS first_snapshot")
        self._append(new, self.table)
        mine = self.digests().where(F.col("first_snapshot").between(min(rows), max(rows))).groupBy(F.col("first_snapshot").alias("snapshot")).agg(F.expr("count(*) AS new_keys"))
        arrived = self.spark.createDataFrame(list(rows.items()), "snapshot bigint, rows bigint")
        counted = arrived.join(mine, "snapshot", "left").selectExpr("rows", "coalesce(new_keys, 0L) AS new_keys", "snapshot")
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("snapshot").parquet(f"{self.path}/counts")

    def _append(self, digests: DataFrame, table: str) -> None:
        writer = digests.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        writer.saveAsTable(table)
        self.spark.catalog.refreshTable(table)

    def compact(self, table: str, path: str) -> SeenKeys:
        """The same store under another name and path with one sorted file per bucket, as appending leaves one per bucket and snapshot."""
        fresh = SeenKeys(self.spark, table, path, self.buckets).attach()
        self._append(self.digests(), fresh.table)
        self.counts().write.partitionBy("snapshot").parquet(f"{path}/counts")
        return fresh


def cumulative_duplicates(counts: DataFrame) -> DataFrame:
    """Per snapshot its rows, keys not seen before and repeats, and all repeats up to it with their rate.

    One row per snapshot, so the running sums fit one task.
    """
    through = "OVER (ORDER BY snapshot)"
    return counts.selectExpr(
        "snapshot",
        "rows",
        "new_keys",
        "rows - new_keys AS repeated",
        f"sum(rows) {through} AS total_rows",
        f"sum(rows - new_keys) {through} AS total_repeated",
        f"CAST(sum(rows - new_keys) {through} AS DOUBLE) / sum(rows) {through} AS duplicate_rate",
    )
