"""The quality report of all snapshots so far from one small state per snapshot.

Every aggregate of the plain checks is kept per snapshot in a form that can be merged: counts and sums add, extremes
combine, deviations are kept as count, mean and sum of squares. References and lookups add their counts, duplicates of
rows and keys come from stores of digests. A new snapshot costs scans of itself; the report of any number of snapshots
reads one row per snapshot and aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import Roles, Thresholds
from plumbline.functions import sqltext as sql
from plumbline.functions.columns import has, nan_to_null
from plumbline.functions.lineage import kept
from plumbline.operators import accuracy, checks, completeness, consistency, custom, timeliness, uniqueness, validity
from plumbline.operators.checks import MAX_AGGREGATES, Check
from plumbline.operators.scoring import finished
from plumbline.operators.seen import SeenKeys
from plumbline.plans.quality import empty_table_check

STATE = "metric string, whole bigint, number double, moment timestamp, mean double, squares double, snapshot bigint"
_ADDED, _EXTREME = {"count", "count_if", "sum"}, {"min", "max"}


def _outer(expression: str) -> tuple[str, str]:
    """The aggregate function of an expression and its argument."""
    found = re.fullmatch(r"\s*(\w+)\((.*)\)\s*", expression, re.DOTALL)
    if found is None or found[1] not in _ADDED | _EXTREME | {"avg", "stddev_samp"}:
        raise ValueError(f"no mergeable form of {expression!r}")
    return found[1], found[2]


def _cells(metric: str, expression: str, kind: T.DataType) -> tuple[dict[str, str], str]:
    """Aggregates that make up the state of a metric, and its row."""
    function, argument = _outer(expression)
    columns = dict.fromkeys(("whole", "number", "moment", "mean", "squares"))
    if function in ("avg", "stddev_samp"):
        columns |= {"whole": f"count({argument})", "mean": f"avg({argument})", "squares": f"var_pop({argument}) * count({argument})"}
    elif function in _ADDED:
        if not isinstance(kind, T.IntegralType):
            raise ValueError(f"no mergeable form of {expression!r}: a sum of other than whole numbers depends on the order")
        columns["whole"] = expression
    elif isinstance(kind, (T.TimestampType, T.DateType)):
        columns["moment"] = expression
    else:
        columns["number"] = expression
    types = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(STATE)}
    named = {c: f"CAST({e} AS {types[c]})" for c, e in columns.items() if e is not None}
    row = {"metric": sql.string(metric)} | {c: sql.name(f"{metric}/{c}") if c in named else f"CAST(NULL AS {types[c]})" for c in columns}
    return {f"{metric}/{c}": e for c, e in named.items()}, sql.struct(row)


def metric_states(df: DataFrame, found: Sequence[Check], snapshot: str) -> DataFrame:
    """The mergeable state of every aggregate of the checks per snapshot, in rows of ``STATE``; one scan per 120 aggregates."""
    inputs = {name: expression for check in found for name, expression in check.inputs.items()}
    df = df.selectExpr("*", *[sql.alias(expression, name) for name, expression in inputs.items()])
    metrics = {name: expression for check in found for name, expression in check.metrics.items()}
    kinds = df.selectExpr(*[sql.alias(expression, name) for name, expression in metrics.items()]).schema
    parts: list[tuple[dict[str, str], list[str]]] = [({}, [])]
    for name, expression in metrics.items():
        aggregates, row = _cells(name, expression, kinds[name].dataType)
        if len(parts[-1][0]) + len(aggregates) > MAX_AGGREGATES:
            parts.append(({}, []))
        parts[-1][0].update(aggregates)
        parts[-1][1].append(row)
    key = F.expr(f"CAST({sql.name(snapshot)} AS BIGINT) AS snapshot")
    grouped = [
        df.groupBy(key).agg(*[F.expr(sql.alias(e, n)) for n, e in aggregates.items()]).selectExpr(sql.inline(rows), "snapshot") for aggregates, rows in parts
    ]
    return reduce(DataFrame.union, grouped)


def merged_metrics(states: DataFrame, found: Sequence[Check]) -> DataFrame:
    """One row holding every metric of the checks over all snapshots of the states, by name."""
    metrics = {name: expression for check in found for name, expression in check.metrics.items()}
    kinds = _kinds(found)
    sums, out = {}, []
    for name, expression in metrics.items():
        function, mine = _outer(expression)[0], f"metric = {sql.string(name)}"
        if function in ("avg", "stddev_samp"):
            sums[name] = f"array_sort(collect_list(CASE WHEN {mine} AND whole > 0 THEN struct(snapshot, whole, mean, squares) END))"
            pooled = (
                f"aggregate({sql.name(name)}, struct(0L AS n, 0D AS mean, 0D AS squares), (a, b) -> struct(a.n + b.whole AS n, "
                "a.mean + (b.mean - a.mean) * b.whole / (a.n + b.whole) AS mean, "
                "a.squares + b.squares + power(b.mean - a.mean, 2) * a.n * b.whole / (a.n + b.whole) AS squares), "
                + ("s -> CASE WHEN s.n > 0 THEN s.mean END)" if function == "avg" else "s -> CASE WHEN s.n > 1 THEN sqrt(s.squares / (s.n - 1)) END)")
            )
            out.append(sql.alias(pooled, name))
            continue
        value = f"CASE WHEN {mine} THEN {'whole' if function in _ADDED else kinds.get(name, 'number')} END"
        sums[name] = f"{function}({value})" if function in _EXTREME else f"coalesce(sum({value}), 0L)"
        out.append(sql.name(name))
    return checks.aggregated(states, sums).selectExpr(*out)


def _kinds(found: Sequence[Check]) -> dict[str, str]:
    """Where the state of an extreme is kept if not as a number: times are computed from an input of the check."""
    return {name: "moment" for check in found for name, e in check.metrics.items() if _outer(e)[0] in _EXTREME and any(_outer(e)[1] == sql.name(i) for i in check.inputs)}


@dataclass(frozen=True)
class QualityStore:
    """What is kept of the snapshots of one table under ``path``: states, counts of references and lookups, digests."""

    spark: SparkSession
    path: str
    name: str
    limits: Thresholds = Thresholds()
    roles: Roles = Roles()
    rules: Sequence[custom.Predicate] = ()
    snapshot: str = "day"
    as_of: object = None
    buckets: int = 64
    stores: dict[str, SeenKeys] = field(default_factory=dict)

    def _seen(self, key: str) -> SeenKeys:
        if key not in self.stores:
            safe = re.sub(r"\W", "_", f"{self.name}_{key}")
            self.stores[key] = SeenKeys(self.spark, safe, f"{self.path}/seen/{safe}", self.buckets).attach()
        return self.stores[key]

    def _plain(self, df: DataFrame, truth: DataFrame | None) -> list[Check]:
        """The checks whose aggregates need no grouping of their own."""
        found = [
            empty_table_check(),
            *completeness.null_rate_checks(df, self.limits),
            *validity.validity_checks(df, self.limits, self.roles, self.as_of),
            *consistency.arithmetic_checks(df, self.roles),
            *timeliness.timeliness_checks(df, self.limits, self.roles, self.as_of),
            *custom.predicate_checks(self.rules),
        ]
        return found + (accuracy.distribution_checks(df, truth) if truth is not None else [])

    def _keys(self, df: DataFrame) -> dict[str, list[str]]:
        """The keys whose repeats are counted: whole rows, then the configured keys."""
        keys = uniqueness.present_keys(df, self.roles)
        return {"rows": df.columns} | {"key_" + "_".join(k): list(k) for k in keys}

    def _joined(self, df: DataFrame, reference: DataFrame | None, known: DataFrame | None) -> list[tuple[Check, DataFrame]]:
        """Checks against other tables with the counts they are read off, per snapshot."""
        found, snapshot = [], sql.name(self.snapshot)
        name, key = self.roles.reference
        if reference is not None and has(df, key):
            keys = df.groupBy(F.expr(f"{snapshot} AS snapshot"), F.expr(f"{sql.name(key)} AS _key")).agg(F.expr("count(*) AS copies"))
            held = reference.selectExpr(f"{sql.name(key)} AS _known").distinct().selectExpr("_known", "true AS _found")
            met = keys.join(held, F.expr("_key <=> _known"), "left").selectExpr("snapshot", "copies", "coalesce(_found, false) AS found")
            found.append((consistency.reference_check(name, key, self.limits), met))
        if known is not None and has(df, self.roles.lookup.key, self.roles.lookup.value):
            pairs = df.selectExpr(f"{snapshot} AS snapshot", f"{sql.name(self.roles.lookup.key)} AS _key", f"{sql.name(self.roles.lookup.value)} AS _value")
            pairs = pairs.dropna(subset=["_key", "_value"]).groupBy("snapshot", "_key", "_value").agg(F.expr("count(*) AS copies"))
            expected = known.groupBy(F.expr("key AS _known")).agg(F.expr("max(value) AS _expected"))
            found.append((consistency.lookup_check(self.roles.lookup), pairs.join(expected, F.expr("_key = _known"), "left")))
        return found

    def absorb(self, df: DataFrame, reference: DataFrame | None = None, known: DataFrame | None = None) -> None:
        """Take in one or more whole snapshots; those taken in before are replaced by the same rows.

        References and lookups are judged by the tables given now. Nothing of earlier snapshots but the digests of keys is
        read, and these are not shuffled. The snapshots are kept once for the scans that this takes.
        """
        df = kept(nan_to_null(df), name="snapshots")
        rows = df.drop(self.snapshot)
        states = metric_states(df, self._plain(rows, df), self.snapshot)
        self._write(states, "states")
        for check, met in self._joined(df, reference, known):
            self._write(metric_states(met, [check], "snapshot"), f"joined/{check.name}")
        for key, columns in self._keys(rows).items():
            self._seen(key).absorb(df, columns, self.snapshot)

    def _write(self, states: DataFrame, folder: str) -> None:
        writer = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("snapshot").parquet(f"{self.path}/{folder}")

    def states(self, folder: str = "states", through: int | None = None) -> DataFrame:
        found = self.spark.read.schema(STATE).parquet(f"{self.path}/{folder}")
        return found if through is None else found.where(F.col("snapshot") <= through)

    def quality_checks(self, like: DataFrame, dataset: str = "table", truth: DataFrame | None = None, with_reference: bool = True, with_lookup: bool = True, through: int | None = None) -> DataFrame:
        """Every quality check over all absorbed snapshots (up to ``through``) in ``CHECK_SCHEMA``.

        ``like`` is a frame with the table's columns, of which no row is read. The result is that of
        ``plans.quality.quality_checks`` over the union of the snapshots.
        """
        rows = nan_to_null(like.drop(self.snapshot))
        plain = self._plain(rows, truth)
        parts = [checks.measured_rows(merged_metrics(self.states("states", through), part), part) for part in checks.chunks(plain)]
        for key, columns in self._keys(rows).items():
            check = uniqueness.exact_check(self.limits) if key == "rows" else uniqueness.key_check(tuple(columns), self.limits)
            counts = self._seen(key).counts()
            counts = counts if through is None else counts.where(F.col("snapshot") <= through)
            parts.append(checks.measured_rows(counts.selectExpr("sum(rows) AS rows", "sum(rows - new_keys) AS repeated"), [check]))
        joined = [consistency.reference_check(*self.roles.reference, self.limits)] if with_reference else []
        joined += [consistency.lookup_check(self.roles.lookup)] if with_lookup else []
        for check in joined:
            row = merged_metrics(self.states(f"joined/{check.name}", through), [check])
            parts.append(checks.measured_rows(row, [check]))
        dimensions = [d for d in checks.DIMENSIONS if d != "accuracy" or truth is not None]
        return finished(checks.with_overalls(reduce(DataFrame.unionByName, parts), dimensions, self.limits), dataset, self.as_of)
