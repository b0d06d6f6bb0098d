"""Exact top-k search against a full scan."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import vafile
from plumbline.llm.vafile import quantise, top_k

SCHEMA = "vec_id long, embedding array<float>, rank int, v string"


def brute(rows, k, scale=64):
    good = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for j, v in good if j == q for i, w in good if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [64, 1 << 29])
def test_matches_full_scan(frame, monkeypatch, scale):
    random.seed(4)
    monkeypatch.setattr(vafile, "VECTOR_BLOCK", 60)
    monkeypatch.setattr(vafile, "QUERY_BYTES", 200)
    rows = [(i, [random.gauss(0, 0.1) for _ in range(6)], 0, "x") for i in range(200)]
    rows += [(i, rows[3][1], 0, "x") for i in range(300, 420)]  # many ties
    rows += [(500, None, 0, ""), (520, [1.0, None], 0, ""), (540, [float("nan")] * 6, 0, ""), (560, [float("inf")] * 6, 0, "")]
    rows += [(None, rows[0][1], 0, ""), (20, rows[5][1], 0, ""), (580, [], 0, ""), (600, [], 0, ""), (620, [0.5, -0.5], 0, ""), (-40, [0.25, 1.0], 0, "")]
    got = top_k(frame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=7, scale=scale)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute(rows, 7, scale)


def test_rows_that_repeat_an_identifier_all_count(frame):
    rows = [(0, [1.0, 0.0], 0, ""), (1, [0.5, 0.0], 0, ""), (1, [0.9, 0.0], 0, ""), (1, [0.9, 0.0], 0, ""), (20, [0.1, 0.2], 0, ""), (20, [0.3, 0.4], 0, "")]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=4).collect()]
    assert sorted(got) == brute(rows, 4) and [g[2:] for g in sorted(got) if g[0] == 0][:3] == [(1, 3648), (1, 3648), (1, 2048)]


def test_equal_vectors_are_read_in_steps(frame, monkeypatch):
    monkeypatch.setattr(vafile, "GATHER_BYTES", 1000)
    rows = [(i, [0.5, 0.25, -0.5], 0, "") for i in range(300)]
    got = top_k(frame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute(rows, 5)


def test_empty_table(frame):
    assert top_k(frame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_values_lie_between_the_edges_of_their_cells():
    exact = np.random.default_rng(1).integers(-30, 30, (500, 4))
    cells, edges = quantise(exact, 3)
    for d in range(4):
        assert (edges[d, cells[:, d]] <= exact[:, d]).all() and (exact[:, d] <= edges[d, cells[:, d] + 1]).all()
