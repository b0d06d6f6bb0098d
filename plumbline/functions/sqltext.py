"""Building blocks of Spark SQL expressions, as text.

A report over a wide table needs thousands of small expressions. Spark parses one SQL text much faster than Python can
assemble the same expression from single column calls, so operators write their expressions as text.
"""

from __future__ import annotations

import math

from plumbline.config import EPSILON


def name(column: str) -> str:
    """A top-level column, whatever characters its name holds."""
    return "`" + column.replace("`", "``") + "`"


def string(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"


def timestamp(value: object | None) -> str:
    """A moment given as text or datetime; None stands for the time of the query."""
    return "current_timestamp()" if value is None else f"CAST({string(str(value))} AS TIMESTAMP)"


def as_double(column: str) -> str:
    """The column as double; adding zero merges -0.0 with 0.0 so that both group together."""
    return f"(CAST({name(column)} AS DOUBLE) + 0D)"


def alias(expression: str, column: str) -> str:
    return f"{expression} AS {name(column)}"


def struct(fields: dict[str, str]) -> str:
    return "struct(" + ", ".join(alias(expression, column) for column, expression in fields.items()) + ")"


def inline(structs: list[str]) -> str:
    return "inline(array(" + ", ".join(structs) + "))"


def inline_present(structs: list[str]) -> str:
    """As ``inline``, leaving out the structs that are null."""
    return "inline(array_compact(array(" + ", ".join(structs) + ")))"


def count_true(condition: str) -> str:
    return f"count_if({condition})"


def tally(condition: str) -> str:
    """Count of rows where the condition holds, in a form that can be summed again."""
    return f"sum(CASE WHEN {condition} THEN 1L ELSE 0L END)"


def rate(part: str, whole: str) -> str:
    """part / whole as double, 0 for an empty whole."""
    return f"(CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) ELSE 0D END)"


def penalty(observed: str, limit: float) -> str:
    """1 at zero, falling linearly to 0 at ``limit``; 1 when there is no limit to fall to."""
    return f"greatest(0D, 1D - {observed} / {double(limit)})" if limit > 0 else "1D"


def attainment(observed: str, target: float) -> str:
    """Share of ``target`` reached, at most 1."""
    return f"least(1D, {observed} / {double(target)})" if target > 0 else "1D"


def entropy_term(share: str) -> str:
    """One summand of the natural-log Shannon entropy, offset so that a zero share stays finite."""
    return f"-({share}) * ln({share} + {double(EPSILON)})"


def sample_skewness(n: str, population: str) -> str:
    """Bias-corrected skewness from the population one; 0 up to three values or without spread."""
    n = f"CAST({n} AS DOUBLE)"
    corrected = f"{population} * sqrt({n} * ({n} - 1)) / ({n} - 2)"
    return f"(CASE WHEN {n} > 3 AND {population} IS NOT NULL AND NOT isnan({population}) THEN {corrected} ELSE 0D END)"


def sample_kurtosis(n: str, population: str) -> str:
    """Bias-corrected excess kurtosis from the population one; 0 up to three values or without spread."""
    n = f"CAST({n} AS DOUBLE)"
    corrected = f"({n} - 1) / (({n} - 2) * ({n} - 3)) * (({n} + 1) * {population} + 6)"
    return f"(CASE WHEN {n} > 3 AND {population} IS NOT NULL AND NOT isnan({population}) THEN {corrected} ELSE 0D END)"
