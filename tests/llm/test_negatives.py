"""Hard negatives against a full comparison, and the bounds against the scores they enclose."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives
from plumbline.llm.negatives import angles, block_bounds, bounds, hard_negatives, references, window

SCHEMA = "vec_id long, embedding array<float>, label int, row string, v string"


def brute(rows, positives=5, found=3, low=50, high=95, scale=256, anchor=50):
    good = []
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, label, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for i, label, v in good:
        if i % anchor:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other == label) for j, other, w in good if j != i and len(w) == len(v))
        for p, j, _ in [x for x in scored if x[2]][:positives]:
            hard = [(n, k) for n, k, same in scored if not same and low * -p <= 100 * -n <= high * -p][:found]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(hard)]
    return sorted(out)


def cloud(seed, n, dim, groups):
    """Vectors around a few directions, of unlike length."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim))
    return (centres[r.integers(groups, size=n)] + r.normal(scale=0.4, size=(n, dim))) * r.uniform(0, 3, size=(n, 1))


@pytest.mark.parametrize("scale", [256, 1 << 27])
def test_matches_full_comparison(frame, monkeypatch, scale):
    monkeypatch.setattr(negatives, "VECTOR_BLOCK", 8)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 400)
    monkeypatch.setattr(negatives, "TILE", 3)
    random.seed(6)
    rows = [(i, v.tolist(), random.randrange(4), "x", "y") for i, v in enumerate(cloud(1, 400, 7, 6))]
    rows += [(i, rows[50][1], i % 2, "x", "y") for i in range(1000, 1060)]  # ties
    rows += [(i, [0.0] * 7, i % 3, "", "") for i in range(1100, 1110)]
    rows += [(2000, None, 1, "", ""), (2050, [1.0, None] + [0.0] * 5, 1, "", ""), (2100, [float("nan")] * 7, 1, "", ""), (2150, [float("inf")] * 7, 1, "", "")]
    rows += [(None, rows[0][1], 1, "", ""), (2200, rows[0][1], None, "", ""), (50, rows[51][1], 2, "", ""), (51, rows[50][1], 2, "", ""), (51, rows[50][1], 2, "", "")]
    rows += [(2250, [], 1, "", ""), (2251, [], 1, "", ""), (2252, [], 2, "", ""), (2300, [0.5, -0.5], 1, "", ""), (2301, [0.5, -0.25], 1, "", ""), (2302, [0.25, 0.0], 0, "", "")]
    rows += [(-100, rows[3][1], 3, "", "")]
    got = hard_negatives(frame(rows, SCHEMA).repartition(6), F.col("vec_id") % 50 == 0, scale=scale)
    assert sorted(map(tuple, got.collect())) == brute(rows, scale=scale)


def test_many_rounds_give_the_same(frame, monkeypatch):
    monkeypatch.setattr(negatives, "VECTOR_BLOCK", 4)
    monkeypatch.setattr(negatives, "GROWTH", 3)
    rows = [(i, v.tolist(), i % 5, "x", "y") for i, v in enumerate(cloud(2, 300, 5, 20))]
    got = hard_negatives(frame(rows, SCHEMA), F.col("vec_id") % 10 == 0, positives=2, negatives=4, low=20, high=90)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 4, 20, 90, anchor=10)


def test_no_rows_no_anchors_no_partners(frame):
    anchors = F.col("vec_id") % 50 == 0
    assert hard_negatives(frame([], SCHEMA), anchors).collect() == []
    assert hard_negatives(frame([(1, [1.0], 1, "", "")], SCHEMA), anchors).collect() == []
    assert hard_negatives(frame([(50, [1.0], 1, "", ""), (None, None, None, None, None)], SCHEMA), anchors).collect() == []


def test_bounds_enclose_every_score():
    for seed, (dim, scale) in enumerate([(2, 1), (3, 256), (16, 4096), (64, 10**5), (1, 50)]):
        a, b = (np.floor(cloud(seed + s, 120, dim, 5) * scale) for s in (0, 100))
        b[:30] = a[:30]
        b[30:60] = -a[30:60]
        b[60:70] = 0
        directions = references(b, 6)
        (na, ta), (nb, tb) = angles(a, directions), angles(b, directions)
        low, high = bounds(na, ta, nb, tb)
        scores = a @ b.T
        assert (low <= scores).all() and (scores <= high).all()
        for part in (slice(0, 10), slice(60, 70), slice(90, 120), slice(0, 120)):
            least, most = block_bounds(na, ta, nb[part], tb[part])
            assert (least <= scores[:, part].min(axis=1)).all() and (scores[:, part].max(axis=1) <= most).all()


def test_bounds_leave_vectors_unscored(monkeypatch):
    """On clustered vectors most pairs need no score."""
    vectors = np.floor(cloud(9, 2000, 32, 8) * 256)
    norms, turned = angles(vectors, references(vectors[:500]))
    low, high = bounds(norms[:100], turned[:100], norms, turned)
    tenth = np.sort(low, axis=1)[:, -10]
    assert (high < tenth[:, None]).mean() > 0.5


def test_references_are_apart_and_few():
    vectors = np.array([[1.0, 0], [2, 0], [0, 0], [0, 3], [-1, 0]])
    assert len(references(vectors, 8)) == 3 and len(references(np.zeros((4, 2)), 8)) == 0 and len(references(vectors, 2)) == 2


def test_window_is_exact():
    for p in [*range(-250, 250), 10**15 + 7]:
        first, last = (int(x[0]) for x in window(np.array([p], np.int64), 50, 95))
        assert (100 * (first - 1) < 50 * p <= 100 * first) and (100 * last <= 95 * p < 100 * (last + 1))
