"""Isolation forest (Liu, Ting and Zhou, 2008) as a fit/transform pair.

Trees are grown in parallel, each from its own few rows, dealt straight from the whole table. The fitted forest is a table
of at most ``trees`` x 2 x ``sample_per_tree`` nodes; every row is then scored in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import sqltext as sql
from plumbline.functions.columns import nan_to_null, numeric_columns, selected
from plumbline.functions.lineage import kept, written
from plumbline.operators.quantiles import exact_from, exact_quantiles_of, quantiles, summaries, summary_columns, summary_metrics

TREES = 100
SAMPLE_PER_TREE = 256
CONTAMINATION = 0.05
MIN_ROWS = 10
MIN_FEATURES = 2
# Features whose medians are found in one sequence of scans, together with the count of rows.
COUNTED_FEATURES = 20
_HASH_RANGE = 1 << 40
_NODE_SCHEMA = "tree int, node int, feature int, split double, below int, above int, length double"


def mean_path(size: int) -> float:
    """Average depth of an unsuccessful search among ``size`` points."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1.0) + np.euler_gamma) - 2.0 * (size - 1.0) / size


def _dealt(df: DataFrame, features: Sequence[str], key: Sequence[str] | None, trees: int, per_tree: int, total: int, seed: int) -> DataFrame:
    """Rows dealt to trees, about 2 x ``per_tree`` each, as (tree, turn, x0, x1, …), straight from the whole table.

    One hash per row gives its first tree and its turn; a row of a small table goes to as many neighbouring trees as
    it takes. Rows with a late turn in a large table are not dealt at all, so what is dealt is bounded by the trees. With
    a key the hash is one of key and features, hence the same however the table is partitioned; else a seeded coin.
    """
    if key:
        hashed = ", ".join([f"{seed}", *[sql.name(c) for c in dict.fromkeys([*key, *features])]])
        order = f"pmod(xxhash64({hashed}), {_HASH_RANGE}L)"
    else:
        order = f"CAST(rand({seed}) * {_HASH_RANGE}L AS BIGINT)"
    share = 2.0 * per_tree * trees / total
    copies = max(1, min(trees, math.ceil(share)))
    xs = [f"x{i}" for i in range(len(features))]
    rows = df.selectExpr(f"{order} AS hash", *[f"{sql.name(f)} AS {x}" for f, x in zip(features, xs, strict=True)])
    if share < 1:
        rows = rows.filter(f"hash DIV {trees} < {math.ceil(_HASH_RANGE / trees * share)}")
    dealt = rows.selectExpr("hash", *xs, f"explode(sequence(0, {copies - 1})) AS copy")
    turn = f"pmod(xxhash64({seed}, hash, copy), {_HASH_RANGE}L) AS turn"
    return dealt.selectExpr(f"CAST(pmod(hash + copy, {trees}) AS INT) AS tree", turn, *xs)


def _grower(width: int, seed: int):
    """Function that grows one tree from the rows of one group."""
    import math as _math

    import numpy as _np
    import pandas as _pd

    def search_depth(size):
        if size <= 1:
            return 0.0
        if size == 2:
            return 1.0
        return 2.0 * (_math.log(size - 1.0) + _np.euler_gamma) - 2.0 * (size - 1.0) / size

    def grow(rows):
        names = [f"x{i}" for i in range(width)]
        tree = int(rows["tree"].iloc[0])
        points = rows.sort_values(["turn", *names])[names].to_numpy(dtype=float)
        random = _np.random.default_rng([seed, tree])
        depth_limit = _math.ceil(_math.log2(max(len(points), 2)))
        nodes = [None]
        waiting = [(0, points, 0)]
        while waiting:
            node, part, depth = waiting.pop()
            spread = _np.flatnonzero(part.max(axis=0) > part.min(axis=0))
            if depth >= depth_limit or len(part) <= 1 or len(spread) == 0:
                nodes[node] = (tree, node, -1, 0.0, node, node, depth + search_depth(len(part)))
                continue
            feature = int(random.choice(spread))
            values = part[:, feature]
            low, high = values.min(), values.max()
            split = random.uniform(low, high)
            if split <= low:
                split = high
            below, above = len(nodes), len(nodes) + 1
            nodes += [None, None]
            nodes[node] = (tree, node, feature, float(split), below, above, 0.0)
            waiting.append((below, part[values < split], depth + 1))
            waiting.append((above, part[values >= split], depth + 1))
        return _pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "below", "above", "length"])

    return grow


def _scorer(nodes: pd.DataFrame, trees: int, per_tree: int):
    """Arrow UDF giving -2 ** -(mean path / expected path): lower is more anomalous."""
    nodes = nodes.sort_values(["tree", "node"])
    sizes = nodes.groupby("tree").size().to_numpy()
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    offsets = np.repeat(roots, sizes)
    feature = nodes["feature"].to_numpy(dtype=np.int64)
    split = nodes["split"].to_numpy()
    below = nodes["below"].to_numpy() + offsets
    above = nodes["above"].to_numpy() + offsets
    length = nodes["length"].to_numpy()
    expected = mean_path(per_tree)
    depth = math.ceil(math.log2(max(per_tree, 2)))

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        import numpy as _np
        import pandas as _pd

        for columns in batches:
            points = _np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = _np.arange(len(points))[:, None]
            at = _np.repeat(roots[None, :], len(points), axis=0)
            for _ in range(depth):
                here = feature[at]
                goes_below = points[rows, _np.maximum(here, 0)] < split[at]
                at = _np.where(here < 0, at, _np.where(goes_below, below[at], above[at]))
            yield _pd.Series(-(2.0 ** -(length[at].mean(axis=1) / expected)))

    return F.pandas_udf(score, "double")


@dataclass(frozen=True)
class IsolationForestModel:
    """A fitted forest: imputation medians, nodes and the score below which a row counts as an anomaly."""

    features: tuple[str, ...]
    medians: dict[str, float]
    nodes: pd.DataFrame
    trees: int
    per_tree: int
    offset: float
    contamination: float
    #: Scores of the rows it was fitted on, as they are stored.
    scores: DataFrame | None = field(default=None, compare=False, repr=False)

    def fitted(self) -> DataFrame:
        """``anomaly_score`` and ``is_anomaly`` of the rows it was fitted on, without scoring them again."""
        scored = self.scores.selectExpr(f"score - {sql.double(self.offset)} AS anomaly_score")
        return scored.selectExpr("*", "anomaly_score < 0 AS is_anomaly")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` (negative = anomalous) and ``is_anomaly`` to every row."""
        scored = nan_to_null(df, self.features).withColumn("anomaly_score", self.raw_score() - F.lit(self.offset))
        return scored.selectExpr("*", "anomaly_score < 0 AS is_anomaly")

    def raw_score(self) -> Column:
        udf = _scorer(self.nodes, self.trees, self.per_tree)
        return udf(*[F.expr(_filled(self.medians, f)) for f in self.features])


def _filled(medians: dict[str, float], feature: str) -> str:
    return f"coalesce({sql.as_double(feature)}, {sql.double(medians[feature])})"


def fit(
    df: DataFrame,
    features: Sequence[str] | None = None,
    key: Sequence[str] | None = None,
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    sample_per_tree: int = SAMPLE_PER_TREE,
    seed: int = 42,
    median_accuracy: int | None = None,
    stored: bool = False,
) -> IsolationForestModel | None:
    """Fit on the whole table; None for fewer than ten rows.

    Every tree gets ``sample_per_tree`` rows of the table, as the algorithm asks. The threshold is the contamination
    quantile of the scores of all rows, which are stored for that as one column. ``key`` should identify rows; it makes
    the trees independent of the partitioning. Features and key are kept once for the scans that follow, unless ``df`` is
    ``stored`` anyway.
    """
    features = tuple(numeric_columns(df) if features is None else features)
    if len(features) < MIN_FEATURES:
        raise ValueError(f"an isolation forest needs at least {MIN_FEATURES} numeric columns, got {list(features)}")
    wanted = list(dict.fromkeys([*features, *(key or [])]))
    df = nan_to_null(selected(df, wanted), features)
    df = df if stored else kept(df, name="features")
    total, found = _counted_medians(df, features, median_accuracy)
    if total < MIN_ROWS:
        return None
    medians = {f: (found[f] or [0.0])[0] for f in features}
    filled = df.selectExpr(*[sql.alias(_filled(medians, c) if c in medians else sql.name(c), c) for c in wanted])
    per_tree = min(sample_per_tree, total)
    xs = [f"x{i}" for i in range(len(features))]
    place = f"row_number() OVER (PARTITION BY tree ORDER BY turn, {', '.join(xs)})"
    dealt = _dealt(filled, features, key, trees, per_tree, total, seed).selectExpr("*", f"{place} AS place")
    hands = dealt.filter(f"place <= {per_tree}").drop("place")
    nodes = hands.groupBy("tree").applyInPandas(_grower(len(features), seed), _NODE_SCHEMA).toPandas()
    unshifted = IsolationForestModel(features, medians, nodes, trees, per_tree, 0.0, contamination)
    scores = written(filled.select(unshifted.raw_score().alias("score")), "scores")
    offset = exact_quantiles_of(scores, {"score": "score"}, (contamination,))["score"][0]
    return replace(unshifted, offset=offset, scores=scores)


def _counted_medians(df: DataFrame, features: Sequence[str], accuracy: int | None) -> tuple[int, dict[str, list[float] | None]]:
    """Number of rows and medians; the rows are counted by the scan that makes the medians' sketches."""
    if accuracy is not None or len(features) > COUNTED_FEATURES:
        total = df.count()
        return total, quantiles(df, features, (0.5,), accuracy) if total >= MIN_ROWS else {}
    df = nan_to_null(selected(df, features))
    values = {f: sql.as_double(f) for f in features}
    row = df.selectExpr("count(*) AS rows", *[sql.alias(e, name) for name, e in summary_metrics(values).items()])
    found = row.selectExpr("rows", *summary_columns(values)).first()
    return found["rows"], exact_from(df, values, (0.5,), summaries(found, values)) if found["rows"] >= MIN_ROWS else {}


def summary(scored: DataFrame, model: IsolationForestModel) -> DataFrame:
    """The forest's check over all scored rows: a rate near the contamination scores high."""
    counts = scored.selectExpr(
        "count(*) AS rows_analyzed",
        "count_if(is_anomaly) AS anomalies_detected",
        "min(anomaly_score) AS min_score",
        "max(anomaly_score) AS max_score",
        "avg(anomaly_score) AS mean_score",
    )
    rated = counts.selectExpr("*", f"{sql.rate('anomalies_detected', 'rows_analyzed')} AS anomaly_rate")
    contamination = sql.double(model.contamination)
    return rated.selectExpr(
        "*",
        f"{sql.string(','.join(model.features))} AS features_used",
        f"{model.trees} AS trees",
        f"anomaly_rate <= {contamination} * 1.5D AS passed",
        f"greatest(0D, 1D - abs(anomaly_rate - {contamination}) * 5) AS score",
        f"{contamination} AS threshold",
    )


def most_anomalous(scored: DataFrame, keep: Sequence[str], k: int = 20) -> DataFrame:
    """The k anomalies with the lowest scores, with the columns ``keep``."""
    columns = [sql.name(c) for c in ("anomaly_score", *keep)]
    return scored.filter("is_anomaly").selectExpr(*columns).orderBy(*columns).limit(k)


def check_rows(df: DataFrame, key: Sequence[str] | None = None, **options) -> DataFrame | None:
    """Isolation forest in the common check schema; None if the table is too small for one.

    A table with fewer than two numeric columns passes, as there is nothing to combine.
    """
    features = options.pop("features", None) or numeric_columns(df)
    if len(features) < MIN_FEATURES:
        return df.sparkSession.range(1).selectExpr(
            "'anomaly_iforest' AS dimension",
            "'iforest_insufficient_features' AS check",
            f"{sql.string(None)} AS column",
            "true AS passed",
            "1D AS score",
            "0D AS threshold",
            f"to_json(named_struct('error', 'at least {MIN_FEATURES} numeric columns are needed')) AS details",
            "1D AS basis",
        )
    model = fit(df, features, key, **options)
    if model is None:
        return None
    return summary(model.fitted(), model).selectExpr(
        "'anomaly_iforest' AS dimension",
        "'isolation_forest' AS check",
        f"{sql.string(None)} AS column",
        "passed",
        "score",
        "threshold",
        "to_json(struct(rows_analyzed, anomalies_detected, anomaly_rate, min_score, max_score, mean_score, "
        "features_used, trees)) AS details",
        "score AS basis",
    )
