"""Folders of daily CSV files as one table, of which a condition on the snapshot opens only the files it needs.

The source lists the files of a glob, numbers them in the order of their paths and makes one partition of each. Conditions
on the snapshot number are taken over from the optimizer, so that files outside it are never opened; as a stream, files
whose paths sort after all earlier ones arrive as new snapshots. Files are read as text in Arrow batches and turned into
columns of the wanted types by Spark.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from plumbline.functions import sqltext as sql
from plumbline.sources.readers import MISSING_TOKENS, missing_to_null, typed

NAME = "snapshot_files"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
BLOCK_BYTES = 4 << 20

#: What a condition on the snapshot keeps.
_KEPT = {
    EqualTo: lambda day, value: day == value,
    EqualNullSafe: lambda day, value: day == value,
    In: lambda day, value: day in value,
    GreaterThan: lambda day, value: day > value,
    GreaterThanOrEqual: lambda day, value: day >= value,
    LessThan: lambda day, value: day < value,
    LessThanOrEqual: lambda day, value: day <= value,
}


@dataclass
class SnapshotFile(InputPartition):
    """One file and its number."""

    day: int
    path: str


def _store(path: str):
    """The file system of a path or URI, which may be a glob, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    host, _, inner = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return store, f"{base.rstrip('/')}/{inner}"


def listed(path: str) -> list[str]:
    """The files of a glob (a folder, a file, or a pattern with * ? [] in any part), in the order of their paths."""
    from pyarrow import fs

    store, pattern = _store(path)
    parts = pattern.rstrip("/").split("/")
    fixed = next((k for k, part in enumerate(parts) if set(part) & set("*?[")), len(parts))
    base = "/".join(parts[:fixed]) or "/"
    info = store.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        return []
    if info.type == fs.FileType.File:
        return [info.path]
    found = store.get_file_info(fs.FileSelector(base, recursive=True))
    names = [f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    if fixed == len(parts):
        return sorted(names)
    return sorted(n for n in names if n.count("/") == pattern.count("/") and all(map(fnmatch.fnmatchcase, n.split("/"), parts)))


def _header(path: str, name: str, options: dict) -> list[str]:
    from pyarrow import csv

    store, _ = _store(path)
    with store.open_input_stream(name) as source:
        return csv.open_csv(source, read_options=csv.ReadOptions(block_size=1 << 20), parse_options=_parsing(options)).schema.names


def _parsing(options: dict):
    from pyarrow import csv

    return csv.ParseOptions(delimiter=options.get("sep", ","), newlines_in_values=True)


def _batches(path: str, file: SnapshotFile, schema: T.StructType, snapshot: str, options: dict) -> Iterator[pa.RecordBatch]:
    """A file's rows as text, with its number; columns that it lacks are null, columns that are not asked for left out."""
    from pyarrow import csv

    columns = [f.name for f in schema.fields if f.name != snapshot]
    store, _ = _store(path)
    reading = csv.ReadOptions(block_size=BLOCK_BYTES)
    converting = csv.ConvertOptions(column_types={c: pa.string() for c in columns}, include_columns=columns, include_missing_columns=True, strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=True)
    with store.open_input_stream(file.path) as source:
        for batch in csv.open_csv(source, reading, _parsing(options), converting):
            arrays = {c: batch.column(k).cast(pa.string()) for k, c in enumerate(columns)}
            arrays[snapshot] = pa.array([file.day] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([arrays[f.name] for f in schema.fields], names=schema.names)


class SnapshotReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, snapshot: str, options: dict):
        self.path, self.schema, self.snapshot, self.options = path, schema, snapshot, options
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take over what is said of the snapshot alone; the rest stays with Spark."""
        for condition in filters:
            mine = getattr(condition, "attribute", None) == (self.snapshot,)
            if mine and type(condition) in _KEPT:
                self.conditions.append(condition)
            elif not (mine and isinstance(condition, IsNotNull)):
                yield condition

    def partitions(self) -> Sequence[SnapshotFile]:
        files = [SnapshotFile(day, name) for day, name in enumerate(listed(self.path), 1)]
        return [f for f in files if all(_KEPT[type(c)](f.day, c.value) for c in self.conditions)]

    def read(self, partition: SnapshotFile) -> Iterator[pa.RecordBatch]:
        # where no file is left, Spark reads one empty partition
        if isinstance(partition, SnapshotFile):
            yield from _batches(self.path, partition, self.schema, self.snapshot, self.options)


class SnapshotStream(DataSourceStreamReader):
    """Offsets are the last path seen and how many files that makes; a file that sorts before it is not taken any more."""

    def __init__(self, path: str, schema: T.StructType, snapshot: str, options: dict):
        self.path, self.schema, self.snapshot, self.options = path, schema, snapshot, options

    def initialOffset(self) -> dict:
        return {"path": "", "count": 0}

    def latestOffset(self) -> dict:
        names = listed(self.path)
        return {"path": names[-1] if names else "", "count": len(names)}

    def partitions(self, start: dict, end: dict) -> Sequence[SnapshotFile]:
        names = [n for n in listed(self.path) if start["path"] < n <= end["path"]]
        return [SnapshotFile(start["count"] + k, n) for k, n in enumerate(names, 1)]

    def read(self, partition: SnapshotFile) -> Iterator[pa.RecordBatch]:
        yield from _batches(self.path, partition, self.schema, self.snapshot, self.options)


class SnapshotFiles(DataSource):
    """``spark.read.format("snapshot_files").load(glob)``; option ``snapshot`` names the number's column (day)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    @property
    def _snapshot(self) -> str:
        return self.options.get("snapshot", "day")

    def schema(self) -> T.StructType:
        path = self.options["path"]
        files = listed(path)
        if not files:
            raise ValueError(f"no snapshot files at {path!r}")
        columns = [c for c in _header(path, files[0], dict(self.options)) if c != self._snapshot]
        return T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField(self._snapshot, T.LongType())])

    def reader(self, schema: T.StructType) -> SnapshotReader:
        return SnapshotReader(self.options["path"], schema, self._snapshot, dict(self.options))

    def streamReader(self, schema: T.StructType) -> SnapshotStream:
        return SnapshotStream(self.options["path"], schema, self._snapshot, dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let it take over conditions."""
    spark.dataSource.register(SnapshotFiles)
    spark.conf.set(PUSHDOWN, "true")


def _as_text(schema: T.StructType, snapshot: str) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema.fields if f.name != snapshot), T.StructField(snapshot, T.LongType())])


def _converted(df: DataFrame, schema: T.StructType, snapshot: str) -> DataFrame:
    """Text in the types of a schema; what is not of its type is null."""
    cast = [sql.alias(f"try_cast({sql.name(f.name)} AS {f.dataType.simpleString()})", f.name) for f in schema.fields if f.name != snapshot]
    return df.selectExpr(*cast, sql.name(snapshot))


def read_snapshots(spark: SparkSession, path: str, schema: str | T.StructType | None = None, snapshot: str = "day", tokens: Sequence[str] = MISSING_TOKENS, **options) -> DataFrame:
    """All snapshot files of a glob with their number, from 1 in the order of their paths, in the column ``snapshot``.

    Without a schema the columns are those of the first file, with the narrowest types that all values of all files have,
    which takes a scan of its own. A column that a file lacks is null there. Tokens such as NA are read as missing. The
    path has to be in a store that pyarrow reads (local, HDFS, S3, GCS); ``readers.scan_snapshots`` takes any of Spark's.
    """
    register(spark)
    reader = spark.read.format(NAME).options(path=path, snapshot=snapshot, **options)
    if schema is None:
        return typed(missing_to_null(reader.load(), tokens))
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _converted(missing_to_null(reader.schema(_as_text(wanted, snapshot)).load(), tokens), wanted, snapshot)


def stream_snapshots(spark: SparkSession, path: str, schema: str | T.StructType, snapshot: str = "day", tokens: Sequence[str] = MISSING_TOKENS, **options) -> DataFrame:
    """The same as a stream: every file whose path sorts after those before is a new snapshot."""
    register(spark)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    stream = spark.readStream.format(NAME).options(path=path, snapshot=snapshot, **options).schema(_as_text(wanted, snapshot)).load()
    return _converted(missing_to_null(stream, tokens), wanted, snapshot)
