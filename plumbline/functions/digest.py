"""Row digests: a fixed-width stand-in for a whole row in a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.functions.columns import as_key

# Bytes of the fixed-width types.
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8,
    T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def width_of(data_type: T.DataType) -> int | None:
    """Bytes of a fixed-width type, None for the others."""
    return _WIDTHS.get(type(data_type))


def row_width(df: DataFrame) -> int | None:
    """Bytes of a row made of fixed-width columns, None if any column varies in width."""
    widths = [width_of(f.dataType) for f in df.schema.fields]
    return None if None in widths else sum(widths)


def row_digest(df: DataFrame, columns: Sequence[str]) -> str:
    """SHA-256 over an unambiguous encoding of the columns: 32 bytes.

    Each cell ends in '|' and a null is '-'. Text that may itself hold these carries its length in front.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for column in columns:
        text = as_key(types[column], column)
        if width_of(types[column]) is None:
            text = f"concat(CAST(octet_length({text}) AS STRING), ':', {text})"
        cells.append(f"coalesce({text}, '-'), '|'")
    return f"unhex(sha2(concat({', '.join(cells)}), 256))"
