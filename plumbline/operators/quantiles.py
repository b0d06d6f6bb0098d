"""Exact quantiles of numeric columns without sorting the table or holding a column in one task.

Spark's ``percentile`` keeps every distinct value of a column in one task; ``percentile_approx`` does not but is not
exact. Here one scan makes a mergeable sketch of every column, which brackets each wanted rank; a second one counts the
rows before each bracket and the distinct values inside, which fixes the rank exactly. Where too many rows lie inside, or
a sketch is off, the bracket is narrowed on a linear grid in further scans. All counts are taken on the map side over a
bounded number of intervals, whatever the distribution. As with ``DataFrame.approxQuantile`` the result, a handful of
numbers per column, is returned to the caller.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null

# Values a sketch keeps on its lowest level, and points at which it is asked for quantiles.
SKETCH_SIZE = 4096
GRID = 1024
# Each refinement splits an interval into this many.
LINEAR_STEPS = 4096
# Brackets that hold about this many rows in total are resolved by counting their distinct values.
DIRECT_ROWS = 1_000_000
# Columns handled by one sequence of scans; each scan reads only its own columns.
_COLUMNS_AT_ONCE = 30


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far, as a share of all values, the rank of a sketch's quantile is off in at most one of a hundred cases."""
    return 2.296 / size**0.9021  # fixed values: the published fit of the KLL sketch


def sketch_of(value: str, size: int = SKETCH_SIZE) -> str:
    return f"kll_sketch_agg_double({value}, {int(size)})"


def grid_of(sketch: str) -> str:
    """Quantiles of a sketch at GRID + 1 even points."""
    # one literal, since a query of many columns would hold thousands
    points = ",".join(repr(i / GRID) for i in range(GRID + 1))
    return f"kll_sketch_get_quantile_double({sketch}, CAST(split('{points}', ',') AS ARRAY<DOUBLE>))"


@dataclass(frozen=True)
class Summary:
    """What one scan says of an expression: its number of values, extremes, and quantiles by a sketch at even points."""

    values: int
    least: float
    greatest: float
    grid: Sequence[float]
    error: float = rank_error()

    def bracket(self, low: float, high: float) -> tuple[float, float]:
        """Values between which the ranks from ``low`` to ``high`` (shares of all) most likely lie."""
        slack = self.error + 2 / self.values
        first, last = math.floor((low - slack) * GRID), math.ceil((high + slack) * GRID)
        return self.grid[first] if first > 0 else self.least, self.grid[last] if last < GRID else self.greatest

    def distances(self, center: float, share: float) -> tuple[float, float]:
        """Distances from ``center`` between which the one that most likely encloses a share of all values lies."""
        slack = self.error + 2 / self.values
        reach = sorted({abs(v - center) for v in (self.least, self.greatest, *self.grid) if math.isfinite(v - center)}) or [0.0]

        def rank(value: float, side) -> float:
            return side(self.grid, value) / GRID

        # the share within d is at most that from the last grid point before to the first one after
        least = [d for d in reach if rank(center + d, bisect.bisect_right) - rank(center - d, bisect.bisect_left) + 2 * slack + 2 / GRID < share]
        most = [d for d in reach if rank(center + d, bisect.bisect_right) - rank(center - d, bisect.bisect_left) - 2 * slack - 2 / GRID > share]
        farthest = max(self.greatest - center, center - self.least, 0.0)
        return least[-1] if least else 0.0, most[0] if most else farthest


def summary_metrics(values: Mapping[str, str]) -> dict[str, str]:
    """The aggregates that ``summaries`` reads, so that a scan for other ends can carry them."""
    found = {}
    for i, value in enumerate(values.values()):
        found |= {f"_n{i}": f"count({value})", f"_l{i}": f"min({value})", f"_g{i}": f"max({value})", f"_s{i}": sketch_of(value)}
    return found


def summary_columns(values: Mapping[str, str]) -> list[str]:
    """What to select of a row that holds ``summary_metrics``."""
    numbers = [c for i in range(len(values)) for c in (f"_n{i}", f"_l{i}", f"_g{i}")]
    return [*numbers, *[f"CASE WHEN _n{i} > 0 THEN {grid_of(f'_s{i}')} END AS _q{i}" for i in range(len(values))]]


def summaries(found: Row, values: Mapping[str, str]) -> dict[str, Summary | None]:
    """Summaries of expressions from the selected row; None without values."""
    return {c: Summary(found[f"_n{i}"], found[f"_l{i}"], found[f"_g{i}"], found[f"_q{i}"]) if found[f"_n{i}"] else None for i, c in enumerate(values)}


@dataclass
class _Rank:
    """The value at a position (from 0) of the ordered values of a column, known to lie in [low, high]."""

    column: str
    position: int
    low: float
    high: float
    rows: float

    @property
    def settled(self) -> bool:
        return self.low == self.high


def _zones(ranks: Sequence[_Rank]) -> list[tuple[float, float]]:
    """Brackets in order; those that meet are one."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted((r.low, r.high) for r in ranks):
        if merged and low <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(high, merged[-1][1])
        else:
            merged.append((low, high))
    return merged


def _zone(value: str, brackets: Sequence[tuple[float, float]]) -> str:
    """Odd numbers inside the brackets, even ones between them."""
    tests = []
    for k, (low, high) in enumerate(brackets):
        tests += [f"WHEN {value} < {sql.double(low)} THEN {2 * k}", f"WHEN {value} <= {sql.double(high)} THEN {2 * k + 1}"]
    return f"CASE {' '.join(tests)} ELSE {2 * len(brackets)} END"


def _step(brackets: Sequence[tuple[float, float]], few: bool) -> str:
    """The value itself if there are few inside the brackets, else its place on a linear grid; 0 between brackets."""
    inside = []
    for k, (low, high) in enumerate(brackets):
        # halving first keeps the widest intervals finite; infinite bounds stand at the ends
        low, high = max(low, -1.7976931348623157e308), min(high, 1.7976931348623157e308)
        share = f"(greatest(least(value, {sql.double(high)}), {sql.double(low)}) / 2 - {sql.double(low)} / 2) / ({sql.double(high)} / 2 - {sql.double(low)} / 2)"
        beyond = f"CASE WHEN value < {sql.double(low)} THEN -1D WHEN value > {sql.double(high)} THEN {LINEAR_STEPS + 1}D"
        text = "value" if few or low >= high else f"{beyond} ELSE floor({share} * {LINEAR_STEPS}) END"
        inside.append(f"WHEN zone = {2 * k + 1} THEN CAST({text} AS DOUBLE)")
    return f"CASE {' '.join(inside)} ELSE 0D END"


def _narrow(df: DataFrame, values: Mapping[str, str], ranks: Sequence[_Rank]) -> None:
    """Narrow every open rank to a smaller interval, in place, in one scan."""
    names = list(dict.fromkeys(r.column for r in ranks))
    brackets = {c: _zones([r for r in ranks if r.column == c]) for c in names}
    few = sum({(r.column, r.low, r.high): r.rows for r in ranks}.values()) <= DIRECT_ROWS
    pieces = [f"CASE WHEN {values[c]} IS NOT NULL THEN struct({i} AS item, {values[c]} AS value, {_zone(values[c], brackets[c])} AS zone) END" for i, c in enumerate(names)]
    cells = df.selectExpr(sql.inline_present(pieces))
    step = "CASE item " + " ".join(f"WHEN {i} THEN {_step(brackets[c], few)}" for i, c in enumerate(names)) + " END"
    counted = cells.groupBy("item", "zone", F.expr(f"{step} AS step")).agg(*map(F.expr, ("count(*) AS copies", "min(value) AS least", "max(value) AS greatest")))
    placed = counted.selectExpr("*", "sum(copies) OVER (PARTITION BY item ORDER BY zone, step) AS through")
    hits = [
        f"CASE WHEN item = {names.index(r.column)} AND through - copies <= {r.position} AND {r.position} < through THEN {k} END"
        for k, r in enumerate(ranks)
    ]
    found = placed.selectExpr(f"explode(array_compact(array({', '.join(hits)}))) AS wanted", "copies", "least", "greatest").collect()
    for row in found:
        rank = ranks[row["wanted"]]
        rank.low, rank.high, rank.rows = row["least"], row["greatest"], row["copies"]


def exact_from(
    df: DataFrame,
    values: Mapping[str, str],
    probabilities: Sequence[float],
    known: Mapping[str, Summary | None],
    brackets: Mapping[str, Sequence[tuple[float, float]]] | None = None,
) -> dict[str, list[float] | None]:
    """As ``exact_quantiles_of``, from summaries that were made before; ``brackets`` may say better where to look."""
    result: dict[str, list[float] | None] = dict.fromkeys(values)
    ranks: dict[tuple[str, int], _Rank] = {}
    wanted: dict[str, list[tuple[int, int, float]]] = {}
    for column in values:
        summary = known.get(column)
        if summary is None:
            continue
        for k, p in enumerate(probabilities):
            place = (summary.values - 1) * p
            low, high = brackets[column][k] if brackets else summary.bracket(p, p)
            for position in (math.floor(place), math.ceil(place)):
                share = 2 * (summary.error + 2 / summary.values) + 2 / GRID
                ranks.setdefault((column, position), _Rank(column, position, low, high, summary.values * share))
            wanted.setdefault(column, []).append((math.floor(place), math.ceil(place), place - math.floor(place)))
    # a bracket that is one value has to be confirmed by a count like all others
    open_ranks = list(ranks.values())
    while open_ranks:
        _narrow(df, values, open_ranks)
        open_ranks = [r for r in open_ranks if not r.settled]
    for column, places in wanted.items():
        ends = [(ranks[column, a].low, ranks[column, b].low, weight) for a, b, weight in places]
        result[column] = [low if weight == 0 else low + (high - low) * weight for low, high, weight in ends]
    return result


def exact_quantiles_of(
    df: DataFrame, values: Mapping[str, str], probabilities: Sequence[float]
) -> dict[str, list[float] | None]:
    """Quantiles of double expressions (SQL text), interpolated linearly between neighbouring ranks.

    None for an expression without values. ``df`` must give the same rows each time it is read.
    """
    names = list(values)
    result: dict[str, list[float] | None] = {}
    for start in range(0, len(names), _COLUMNS_AT_ONCE):
        part = {c: values[c] for c in names[start : start + _COLUMNS_AT_ONCE]}
        row = df.selectExpr(*[sql.alias(expression, name) for name, expression in summary_metrics(part).items()])
        result |= exact_from(df, part, probabilities, summaries(row.selectExpr(*summary_columns(part)).first(), part))
    return result


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int | None = None
) -> dict[str, list[float] | None]:
    """Quantiles of numeric columns: exact, or from ``percentile_approx`` (one scan) if an accuracy is given."""
    df = nan_to_null(df, columns)
    if accuracy is None:
        return exact_quantiles_of(df, {c: sql.as_double(c) for c in columns}, probabilities)
    points = f"array({', '.join(sql.double(p) for p in probabilities)})"
    row = df.selectExpr(*[f"percentile_approx({sql.as_double(c)}, {points}, {int(accuracy)})" for c in columns]).first()
    return dict(zip(columns, row, strict=True))
