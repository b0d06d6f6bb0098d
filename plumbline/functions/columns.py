"""Column selection by type, null normalisation and safe parsing. Expressions are SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.functions import sqltext as sql

_DATETIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def numeric_columns(df: DataFrame, booleans: bool = False) -> list[str]:
    kinds = (T.NumericType, T.BooleanType) if booleans else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def string_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _DATETIME)]


def kind_of(data_type: T.DataType) -> str:
    """Booleans count as numeric in profiles; what is neither numeric nor a date or time is categorical."""
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return "numeric"
    return "datetime" if isinstance(data_type, _DATETIME) else "categorical"


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if kind_of(f.dataType) == "categorical"]


def selected(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.selectExpr(*[sql.name(c) for c in columns])


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Treat NaN as missing, as every check does; a projection, so it costs no extra pass."""
    wanted = set(df.columns if columns is None else columns)
    floats = {
        f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    if not floats:
        return df
    return df.selectExpr(
        *[
            sql.alias(f"CASE WHEN NOT isnan({sql.name(c)}) THEN {sql.name(c)} END", c) if c in floats else sql.name(c)
            for c in df.columns
        ]
    )


def as_text(data_type: T.DataType, name: str) -> str:
    """A string form usable as a grouping value: equal values give equal strings."""
    column = sql.name(name)
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return f"CAST({column} + CAST(0 AS {data_type.simpleString()}) AS STRING)"
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return f"to_json({column})"
    if isinstance(data_type, T.BinaryType):
        return f"hex({column})"
    return f"CAST({column} AS STRING)"


def as_key(data_type: T.DataType, name: str) -> str:
    """As ``as_text``, for grouping only: an instant is its microseconds, since its local text can name two instants."""
    if isinstance(data_type, T.TimestampType):
        return f"CAST(unix_micros({sql.name(name)}) AS STRING)"
    return as_text(data_type, name)


def as_timestamp(df: DataFrame, name: str, formats: Sequence[str] = ()) -> str:
    """Parse to TIMESTAMP; what cannot be parsed becomes null instead of failing the job."""
    column = sql.name(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return f"CAST({column} AS TIMESTAMP)"
    attempts = [f"try_to_timestamp({column})", *(f"try_to_timestamp({column}, {sql.string(f)})" for f in formats)]
    return attempts[0] if len(attempts) == 1 else f"coalesce({', '.join(attempts)})"


def long_form(df: DataFrame, columns: Sequence[str], text=as_text) -> DataFrame:
    """One row per cell: (column, value as text)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = df.selectExpr(*[sql.alias(text(types[c], c), c) for c in columns])
    return cells.unpivot([], [sql.name(c) for c in columns], "column", "value")
