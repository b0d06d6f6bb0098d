"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random

import pytest

from plumbline.llm import cells
from plumbline.llm.components import components
from plumbline.llm.jaccard import link_components

SCHEMA = "doc_id long, text string"


def shingles(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and rows[a][0] is not None and rows[b][0] is not None and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), None if i is None else least[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def edited(words, share):
    return [f"n{random.random()}" if random.random() < share else w for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(frame, seed, monkeypatch):
    random.seed(seed)
    monkeypatch.setattr(cells, "CHUNK_BYTES", 9000)
    monkeypatch.setattr(cells, "BUCKET_BYTES", 9000)
    rows = []
    for _ in range(4):
        base = [random.choice("abcdefghij") + random.choice("klmno") for _ in range(120)]
        chain = base
        for _ in range(12):
            rows.append(" ".join(edited(base, random.choice([0, 0.01, 0.03, 0.06]))))
            chain = edited(chain, 0.02)
            rows.append(" ".join(chain))
    rows = list(enumerate([*rows, "A b c", "a B c", "a b", "a b", "", None, "É b c d e f", "é b c d e f"]))
    random.shuffle(rows)
    rows += [(None, rows[0][1]), (3, dict(rows)[3])]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in link_components(frame(rows, SCHEMA)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(frame):
    assert link_components(frame([], SCHEMA)).collect() == []


def test_components_of_paths_cycles_and_loops(frame):
    path = [(k, k + 1) for k in range(40, 60)] + [(10, 12), (12, 11), (11, 10), (5, 5), (None, 3), (99, 40)]
    got = {r.node: r.component for r in components(frame(path, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(40, 61), 99], 40), 10: 10, 11: 10, 12: 10}
