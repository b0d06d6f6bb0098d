"""Tables from files and databases as DataFrames.

``resolve`` maps a source string to a Spark format and its options without touching the source; ``read_source`` reads
it. Connections, splitting and pushdown are Spark's.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import as_text, nan_to_null, numeric_columns
from plumbline.operators.checks import aggregated, per_column

# Names a source may be given by, and the tokens read as missing in text files.
FILE_FORMATS = {"csv": "csv", "parquet": "parquet", "json": "json", "orc": "orc"}
EXTENSIONS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".orc": "orc"}
DATABASES = {"postgresql": "postgresql", "postgres": "postgresql", "pg": "postgresql", "snowflake": "snowflake"}
MISSING_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)
# What text must look like for a type, from narrow to wide.
_TEXT_TYPES = (
    ("INT", "try_cast({0} AS INT) IS NOT NULL"),
    ("BIGINT", "try_cast({0} AS BIGINT) IS NOT NULL"),
    ("DOUBLE", "try_cast({0} AS DOUBLE) IS NOT NULL AND NOT {0} RLIKE '[dDfF]$'"),
    ("DATE", "try_cast({0} AS DATE) IS NOT NULL AND {0} RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$'"),
    ("TIMESTAMP", "try_cast({0} AS TIMESTAMP) IS NOT NULL AND {0} RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}'"),
    ("BOOLEAN", "lower({0}) IN ('true', 'false')"),
)
DESCRIPTIONS = {
    "csv": "CSV files",
    "parquet": "Parquet files",
    "json": "JSON lines files",
    "orc": "ORC files",
    "postgresql": "PostgreSQL tables and queries through JDBC (driver jar on the classpath)",
    "snowflake": "Snowflake tables and queries (Spark connector on the classpath)",
}


@dataclass(frozen=True)
class Source:
    """A Spark data source: format, reader options and, for files, a path."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None


def list_sources() -> dict[str, str]:
    return dict(DESCRIPTIONS)


def _supported() -> str:
    return ", ".join([*FILE_FORMATS, *DATABASES])


def jdbc_options(
    host: str,
    database: str,
    table: str | None = None,
    query: str | None = None,
    port: int = 5432,
    user: str | None = None,
    password: str | None = None,
    schema: str = "public",
    limit: int | None = None,
    partition: tuple[str, object, object, int] | None = None,
) -> dict[str, str]:
    """Reader options for a PostgreSQL table or query.

    ``partition`` (column, lower, upper, parts) splits the read over as many tasks; without it one task reads
    everything. A ``limit`` is evaluated by the database, through a query.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{database}?currentSchema={schema}",
        "driver": "org.postgresql.Driver",
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    name = None if table is None else f'"{schema}"."{table}"'
    if limit is not None:
        options["query"] = f"SELECT * FROM {name or f'({query}) AS source'} LIMIT {int(limit)}"
    elif query is not None and partition is not None:
        options["dbtable"] = f"({query}) AS source"
    elif query is not None:
        options["query"] = query
    else:
        options["dbtable"] = name
    if partition is not None:
        if limit is not None:
            raise ValueError("a limited read cannot be split")
        column, lower, upper, parts = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def snowflake_options(
    account: str,
    user: str | None = None,
    password: str | None = None,
    database: str | None = None,
    schema: str = "PUBLIC",
    warehouse: str | None = None,
    role: str | None = None,
    table: str | None = None,
    query: str | None = None,
    limit: int | None = None,
) -> dict[str, str]:
    """Reader options of the Snowflake connector for a table or query."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if limit is not None:
        query = f"SELECT * FROM {f'({query})' if table is None else f'"{database}"."{schema}"."{table}"'} LIMIT {int(limit)}"
        table = None
    options = {
        "sfURL": f"{account}.snowflakecomputing.com",
        "sfUser": user,
        "sfPassword": password,
        "sfDatabase": database,
        "sfSchema": schema,
        "sfWarehouse": warehouse,
        "sfRole": role,
        "dbtable": table,
        "query": query,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def resolve(source: str, table: str | None = None, query: str | None = None, limit: int | None = None, **options) -> Source:
    """Turn a connection URI, a type name or a file path into a ``Source``.

    URIs: ``postgresql://user:password@host:port/database?schema=…``,
    ``snowflake://user:password@account/database/schema?warehouse=…&role=…``, ``csv:///path`` and any path with a
    scheme Spark can read. Type names take ``path`` (files) or connection options. Unknown sources raise ValueError.
    """
    if "://" in source:
        parts = urlsplit(source)
        scheme = parts.scheme.lower()
        if scheme in DATABASES:
            return _database(DATABASES[scheme], _dsn_options(DATABASES[scheme], parts), table, query, limit, options)
        if scheme in FILE_FORMATS:
            return _files(FILE_FORMATS[scheme], (parts.netloc + parts.path) or table, options)
        kind = EXTENSIONS.get(os.path.splitext(parts.path)[1].lower())
        if kind is None:
            raise ValueError(f"unknown URI scheme '{scheme}'; supported: {_supported()}")
        return _files(kind, source, options)
    name = source.lower()
    if name in DATABASES:
        return _database(DATABASES[name], {}, table, query, limit, options)
    if name in FILE_FORMATS:
        return _files(FILE_FORMATS[name], options.pop("path", None) or table, options)
    kind = EXTENSIONS.get(os.path.splitext(source)[1].lower())
    if kind is None:
        raise ValueError(f"unknown source '{source}'; supported: {_supported()}, or a path ending in {', '.join(EXTENSIONS)}")
    return _files(kind, source, options)


def _dsn_options(kind: str, parts) -> dict:
    given = dict(parse_qsl(parts.query))
    found = {"user": parts.username and unquote(parts.username), "password": parts.password and unquote(parts.password)}
    path = parts.path.strip("/").split("/")
    if kind == "postgresql":
        found |= {"host": parts.hostname, "port": parts.port, "database": path[0], "schema": given.get("schema")}
    else:
        found |= {
            "account": parts.hostname,
            "database": path[0],
            "schema": path[1] if len(path) > 1 else None,
            "warehouse": given.get("warehouse"),
            "role": given.get("role"),
        }
    return {name: value for name, value in found.items() if value}


def _database(kind: str, found: dict, table, query, limit, options: dict) -> Source:
    arguments = {**found, **options, "table": table, "query": query, "limit": limit}
    if kind == "postgresql":
        arguments.setdefault("host", "localhost")
        return Source("jdbc", jdbc_options(**arguments))
    return Source("net.snowflake.spark.snowflake", snowflake_options(**arguments))


def _files(kind: str, path: str | None, options: dict) -> Source:
    if not path:
        raise ValueError(f"a {kind} source needs a path")
    defaults = {"header": "true"} if kind == "csv" else {}
    return Source(kind, {**defaults, **{name: str(value) for name, value in options.items()}}, path)


def read_source(
    spark: SparkSession,
    source: str,
    table: str | None = None,
    query: str | None = None,
    limit: int | None = None,
    schema: str | T.StructType | None = None,
    **options,
) -> DataFrame:
    """Read a source as a DataFrame. CSV types are found in one pass unless a schema is given."""
    found = resolve(source, table, query, limit, **options)
    reader = spark.read.format(found.format)
    if found.format == "csv":
        reader = reader.option("nullValue", found.options.get("nullValue", ""))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**found.options).load(found.path) if found.path else reader.options(**found.options).load()
    if found.format == "csv":
        df = missing_to_null(df)
        if schema is None and "inferSchema" not in found.options:
            df = typed(df)
    return df.limit(limit) if limit is not None and found.path else df


def missing_to_null(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Null out the usual spellings of a missing value in text columns."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    listed = ", ".join(sql.string(t) for t in tokens)
    return df.selectExpr(
        *[
            sql.alias(f"CASE WHEN {sql.name(c)} NOT IN ({listed}) THEN {sql.name(c)} END", c) if c in texts else sql.name(c)
            for c in df.columns
        ]
    )


def typed(df: DataFrame) -> DataFrame:
    """Cast text columns to the narrowest type that all their values have; all are judged in one pass.

    Columns without values stay text.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    metrics = {}
    for i, c in enumerate(texts):
        value = sql.name(c)
        metrics[f"v{i}"] = f"count({value})"
        metrics |= {f"k{i}_{k}": f"count_if({condition.format(value)})" for k, (_, condition) in enumerate(_TEXT_TYPES)}
    if not texts:
        return df
    row = aggregated(df, metrics).first()
    kinds = {}
    for i, c in enumerate(texts):
        fitting = [t for k, (t, _) in enumerate(_TEXT_TYPES) if row[f"k{i}_{k}"] == row[f"v{i}"]]
        if row[f"v{i}"] and fitting:
            kinds[c] = fitting[0]
    return df.selectExpr(
        *[sql.alias(f"CAST({sql.name(c)} AS {kinds[c]})", c) if c in kinds else sql.name(c) for c in df.columns]
    )


def scan_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, **options) -> DataFrame:
    return read_source(spark, "csv", path=path, schema=schema, **options)


def _plain_path(path: str) -> str:
    """A local path without its scheme, which is spelled in several ways; other paths as they are."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def scan_snapshots(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, snapshot: str = "day", **options
) -> DataFrame:
    """Read all snapshot files under one glob; the snapshot number is the file's position in order of full paths, from 1.

    The numbered paths are joined back; Spark broadcasts them as long as they are few.
    """
    df = scan_csv(spark, path, schema, **options)
    paths = sorted({_plain_path(unquote(f)) for f in df.inputFiles()})
    numbered = spark.createDataFrame([(p, i) for i, p in enumerate(paths, 1)], f"_file string, `{snapshot}` bigint")
    # "+" is an ordinary character in paths, so it is kept from being decoded as a space
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    file = F.regexp_replace(decoded, "^file:/+", "/")
    return df.select("*", file.alias("_file")).join(numbered, "_file").drop("_file")


def union_snapshots(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns a frame lacks are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def reachable(spark: SparkSession, source: str, table: str | None = None, **options) -> bool:
    """Whether the source can be read; never raises."""
    try:
        read_source(spark, source, table, **options).limit(1).isEmpty()
        return True
    except Exception:
        return False


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Tables and views of the session catalog, sorted."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def table_listing_query(schema: str, kind: str = "postgresql") -> str:
    """Query for the base tables of a database schema, to be passed to ``read_source``."""
    if kind not in {"postgresql", "snowflake"}:
        raise ValueError(f"unknown database {kind!r}")
    name = (schema.upper() if kind == "snowflake" else schema).replace("'", "''")
    return (
        "SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{name}' AND table_type = 'BASE TABLE'"
    )


def schema_inspect(df: DataFrame) -> DataFrame:
    """Name, type, whether nulls occur, the least value as a sample, the longest text's characters (null for other types)
    and the column's default where the source declares one; nulls, samples and lengths are observed over the whole table."""
    df = nan_to_null(df)
    numbers = set(numeric_columns(df))
    cells = []
    for i, f in enumerate(df.schema.fields):
        least = f"min({sql.name(f.name)})" if f.name in numbers else f"min({as_text(f.dataType, f.name)})"
        text = isinstance(f.dataType, T.StringType)
        metrics = {f"n{i}": f"count_if({sql.name(f.name)} IS NULL)", f"s{i}": least}
        metrics |= {f"m{i}": f"max(length({sql.name(f.name)}))"} if text else {}
        fields = {
            "column_name": sql.string(f.name),
            "dtype": sql.string(f.dataType.simpleString()),
            "nullable": f"n{i} > 0",
            "sample": as_text(f.dataType, f"s{i}") if f.name in numbers else f"s{i}",
            "max_length": f"m{i}" if text else "CAST(NULL AS INT)",
            "default": sql.string((f.metadata or {}).get("CURRENT_DEFAULT")),
        }
        cells.append((metrics, sql.struct(fields)))
    return per_column(df, cells)
