"""Decontamination: alignment against a plain table, and planted copies."""

from __future__ import annotations

import random

import numpy as np

from plumbline.llm.decontaminate import align, contaminated, remove_contaminated, seeds

DOCS, ITEMS = "doc_id long, text string, score int, extra string", "item_id long, text string"


def plain_score(item, part):
    best = 0
    table = [[0] * (len(part) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(part) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if item[i - 1] == part[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_score():
    rng = np.random.default_rng(6)
    for _ in range(200):
        item, part = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(0, 20))
        score, a, b = align(item, part)
        assert score == plain_score(item, part) == plain_score(item, part[a:b])


def words(n):
    return [f"w{random.randint(0, 5000)}" for _ in range(n)]


def test_exact_and_edited_copies_are_found_and_others_not(frame):
    random.seed(7)
    items = [(k, " ".join(words(random.randint(14, 50)))) for k in range(30)]
    docs, planted = [], {}
    for d in range(300):
        text = words(random.randint(0, 300))
        if d % 3 == 0:
            item, copy = random.choice(items)
            copy = [w for w in copy.split() if random.random() > 0.06]
            copy = [random.choice(words(1)) if random.random() < 0.08 else w for w in copy]
            at = random.randint(0, len(text))
            text[at:at] = copy
            planted[d] = item
        docs.append((d, " ".join(text).upper() if d % 2 else ", ".join(text), 0, "x"))
    docs += [(900, None, 0, ""), (901, "", 0, ""), (None, items[0][1], 0, ""), (902, items[0][1], 0, ""), (902, items[0][1], 0, "")]
    found = contaminated(frame(docs, DOCS), frame([*items, (99, None), (None, "a b c"), (98, "a b")], ITEMS)).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    missed = [d for d, i in planted.items() if (d, i) not in pairs]
    assert len(missed) <= 2
    assert {d for d, _ in pairs if d is not None} - set(planted) == {902}
    assert sum(r.doc_id == 902 for r in found) == 2 and (None, 0) in pairs
    kept = remove_contaminated(frame(docs, DOCS), frame(items, ITEMS))
    assert kept.columns == ["doc_id", "text", "score", "extra"]
    left = [r.doc_id for r in kept.collect()]
    assert set(left) == {d for d, *_ in docs} - {d for d, _ in pairs} and {900, 901} <= set(left)


def test_empty_tables(frame):
    assert contaminated(frame([], DOCS), frame([(1, "a b c d")], ITEMS)).collect() == []
    assert contaminated(frame([(1, "a b c d", 0, "")], DOCS), frame([], ITEMS)).collect() == []


def test_every_part_of_an_item_has_a_seed():
    chosen = seeds(np.array([9] * 8 + [1] * 8))
    assert all(chosen[k : k + 4].any() for k in range(0, 16, 4))


def test_heavily_edited_copies_are_found_as_without_seeds(frame):
    random.seed(11)
    items = [(k, " ".join(words(random.randint(24, 50)))) for k in range(24)]
    docs = []
    for k, item in items:
        for share in (0.15, 0.2, 0.25):
            copy = item.split()
            for at in range(0, len(copy), round(1 / share)):
                copy[at] = f"x{random.randint(0, 5000)}"
            docs.append((len(docs), " ".join(words(20) + copy + words(20)), 0, ""))
        if k % 2:  # a clean copy gives every n-gram a document
            docs.append((len(docs), item, 0, ""))
    every = {
        (d, i)
        for d, text, *_ in docs
        for i, item in items
        if align(np.array([hash(w) for w in item.split()]), np.array([hash(w) for w in text.split()]))[0] >= len(item.split())
    }
    assert len(every) == len(docs)
    assert {(r.doc_id, r.item_id) for r in contaminated(frame(docs, DOCS), frame(items, ITEMS)).collect()} == every


def test_seeds_occur_and_are_not_far_more_frequent_than_others():
    assert seeds(np.array([0, 1, 0, 500, 90_000, 2])).tolist() == [False, True, False, True, False, True]
    assert seeds(np.array([7000, 7001, 7000, 1])).all() and not seeds(np.array([0, 0])).any()
