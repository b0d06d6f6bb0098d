from __future__ import annotations

import numpy as np
import pytest

from plumbline.functions import sqltext as sql
from plumbline.operators import quantiles as module
from plumbline.operators.quantiles import exact_quantiles_of, quantiles

PROBABILITIES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0)


def _samples() -> dict[str, np.ndarray]:
    random = np.random.default_rng(7)
    return {
        "normal": random.normal(100, 15, 4001),
        "signed": random.normal(0, 1e-3, 4001),
        "clustered": 20 + random.random(4001) * 1e-9,
        "wide": np.exp(random.normal(0, 40, 4001)) * random.choice([-1, 1], 4001),
        "hot": np.where(random.random(4001) < 0.4, 7.0, random.integers(0, 10_000, 4001).astype(float)),
        "sentinel": np.where(random.random(4001) < 0.01, 999999.0, random.integers(1, 10, 4001).astype(float)),
        "zeros": np.where(random.random(4001) < 0.9, 0.0, random.normal(0, 1, 4001)),
        "constant": np.full(4001, 3.25),
    }


@pytest.fixture(scope="module")
def frame(spark):
    samples = _samples()
    rows = [tuple(float(v) for v in row) for row in zip(*samples.values(), strict=True)]
    return spark.createDataFrame(rows, [*samples]).repartition(5).cache()


@pytest.mark.parametrize("direct", [10**6, 50])
def test_exact_on_any_distribution(frame, monkeypatch, direct):
    """Also when so few rows may be resolved directly that every column goes through several refinements."""
    monkeypatch.setattr(module, "DIRECT_ROWS", direct)
    found = quantiles(frame, frame.columns, PROBABILITIES)
    for name, values in _samples().items():
        expected = np.quantile(values, PROBABILITIES)
        assert found[name] == pytest.approx(expected, rel=1e-12, abs=1e-15), name


def test_missing_values_and_signed_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, 0D), (double('NaN'), -0D), (NULL, 0D), (3D, NULL), (2D, 5D) AS t(a, b)")
    df = df.selectExpr("*", "CAST(NULL AS DOUBLE) AS nothing")
    found = quantiles(df, ["a", "b", "nothing"], (0.5,))
    assert found == {"a": [2.0], "b": [0.0], "nothing": None}


def test_infinity_is_an_ordinary_extreme(spark):
    df = spark.sql("SELECT * FROM VALUES (1D), (2D), (double('Infinity')), (double('-Infinity')), (3D) AS t(x)")
    assert quantiles(df, ["x"], (0.5, 0.25, 0.75)) == {"x": [2.0, 1.0, 3.0]}


def test_expression_and_many_columns(spark, monkeypatch):
    monkeypatch.setattr(module, "_COLUMNS_AT_ONCE", 3)
    df = spark.range(1, 102).selectExpr(*[f"CAST(id * {i} AS DOUBLE) AS c{i}" for i in range(1, 8)])
    found = exact_quantiles_of(df, {c: f"abs({sql.as_double(c)} - 51D)" for c in df.columns}, (0.5,))
    for i in range(1, 8):
        assert found[f"c{i}"] == [float(np.median(np.abs(np.arange(1, 102) * i - 51)))]


def test_sketch_mode_is_close(frame):
    found = quantiles(frame, ["normal"], (0.25, 0.5), accuracy=10000)
    assert found["normal"] == pytest.approx(np.quantile(_samples()["normal"], (0.25, 0.5)), rel=1e-2)


def test_does_not_depend_on_partitioning(frame):
    once = quantiles(frame.repartition(1), ["wide", "hot"], (0.37, 0.9))
    assert once == quantiles(frame.repartition(17, "hot"), ["wide", "hot"], (0.37, 0.9))
