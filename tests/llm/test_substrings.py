"""Substring dedup against a plain count of all windows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from plumbline.llm import cells
from plumbline.llm.substrings import remove_repeats

SCHEMA = "doc_id long, text string"


def brute(rows, width):
    first, out = {}, []
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k : k + width])
                first[key] = min(first.get(key, i), i)
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(frame, seed, monkeypatch):
    random.seed(seed)
    monkeypatch.setattr(cells, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(cells, "BUCKET_BYTES", 1500)
    passages = [" ".join(random.choice("ab") + random.choice("cde") for _ in range(9)) for _ in range(5)]
    rows = [(i, "  ".join(random.choice([*passages, "x y", "\tz é\n", f"w{i}"]) for _ in range(random.randint(0, 12)))) for i in range(60)]
    rows += [(None, passages[0]), (None, None), (7, rows[7][1]), (900, ""), (901, None), (-5, passages[1])]
    got = remove_repeats(frame(rows, SCHEMA), width=5).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute(rows, 5)


def test_intervals_are_maximal_and_disjoint(frame):
    text = " ".join(f"w{k}" for k in range(40))
    got = {r.doc_id: r for r in remove_repeats(frame([(1, text), (2, f"new {text} end {text}")], SCHEMA), width=13).collect()}
    assert got[1].n_removed == 0 and not got[1].removed
    assert [(x.start, x.end) for x in got[2].removed] == [(1, 41), (42, 82)]
    assert got[2].kept_text == "new end"


def test_empty_table_and_clashing_columns(spark, frame):
    assert remove_repeats(frame([], SCHEMA)).collect() == []
    odd = frame([(1, "a b", 3, "x", 0)], "doc_id long, text string, chunk long, kept_text string, bucket int")
    assert remove_repeats(odd).first().kept_text == "a b"


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.uint64), rng.integers(0, 2**64, 500, dtype=np.uint64), np.array([5], np.uint64)):
        assert (cells.unpack(cells.pack(values)) == values).all()
        assert (cells.unpack(cells.pack(np.sort(values), ascending=True), ascending=True) == np.sort(values)).all()
    signed = np.array([-3, 7, -(2**62)], np.int64)
    assert (cells.unpack(cells.pack(signed)).view(np.int64) == signed).all()


def test_window_hash_is_that_of_each_window_alone():
    hashes = cells.word_hashes([b"a", b"b", b"a", b"b", b"c"])
    rolled = cells.window_hashes(hashes, 2)
    assert rolled[0] == rolled[2] and rolled[0] != rolled[1]
    assert cells.window_hashes(hashes[2:4], 2)[0] == rolled[2]
