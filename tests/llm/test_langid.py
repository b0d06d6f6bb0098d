"""Naive Bayes language identification against counting by hand, and on held-out texts."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import langid
from plumbline.llm.langid import LanguageModel, cut, ngrams, predict, slices, train
from plumbline.llm.queries import op13_language_id

SCHEMA = "doc_id long, text string, lang string, score int, row string"


def brute_ngrams(text: str) -> list[str]:
    padded = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    grams = [padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)]
    return [g for g in grams if g.strip() and " " not in g[1:-1]]


def bucket(gram: str, bits: int) -> int:
    mixed = 0
    for c, factor in zip(gram, (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35), strict=False):
        mixed = (mixed ^ ord(c)) * factor % 2**32
    return (mixed ^ mixed >> 15) * 0x9E3779B1 % 2**32 >> 32 - bits


TEXTS = ["Ab c", "", "12", "É!", "  two  words\n", "x", "ǅİ Straße 日本 a1b", "...end.", "퟿a b\U0001f600c"]


def test_ngrams_of_every_text_are_those_of_the_plain_rule():
    buckets, starts, has_letter = ngrams(TEXTS, 16)
    ends = [*starts[1:], len(buckets)]
    for text, a, b, letter in zip(TEXTS, starts, ends, has_letter, strict=True):
        assert Counter(buckets[a:b].tolist()) == Counter(bucket(g, 16) for g in brute_ngrams(text)), text
        assert letter == any(c.isalpha() for c in text.lower())


def test_long_texts_are_cut_after_spaces_and_lose_nothing():
    text = "word " * 50
    assert "".join(cut(text, 12)) == text and all(p.endswith(" ") for p in cut(text, 12)[:-1])
    assert cut("a" * 10, 4) == ["aaaa", "aaaa", "aa"] and cut("", 4) == [""]
    parts = list(slices(pa.array(["a b", None, "c"])))
    assert [p for _, some in parts for p in some] == ["a b", "", "c"]


def brute(rows, learn, bits):
    counts, documents = defaultdict(Counter), Counter()
    for i, text, lang, *_ in rows:
        if learn(i) and text is not None and lang is not None:
            counts[lang].update(bucket(g, bits) for g in brute_ngrams(text))
            documents[lang] += any(c.isalpha() for c in text)
    names = sorted(counts)
    total = sum(documents[x] + 1 for x in names)
    found = {}
    for i, text, *_ in rows:
        if text is None or not any(c.isalpha() for c in text):
            found[i] = ("und", 0.0)
            continue
        sums = []
        for x in names:
            size = sum(counts[x].values()) + 0.5 * 2**bits
            sums.append(math.log((documents[x] + 1) / total) + sum(math.log((counts[x][b] + 0.5) / size) for b in (bucket(g, bits) for g in brute_ngrams(text))))
        top = max(sums)
        found[i] = (names[sums.index(top)], 1 / sum(math.exp(s - top) for s in sums))
    return found


def test_predictions_equal_those_counted_by_hand(frame, monkeypatch):
    monkeypatch.setattr(langid, "SLICE_CHARACTERS", 40)
    monkeypatch.setattr(langid, "HELD_LANGUAGES", 1)
    random.seed(3)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["shu", "ter", "lo"], "cc": ["ñe", "lo", "ter"]}
    rows = []
    for i in range(120):
        lang = random.choice(list(sounds))
        words = ["".join(random.choices(sounds[lang], k=random.randint(1, 3))) for _ in range(random.randint(0, 12))]
        rows.append((i, " ".join(words), lang, 7, "r"))
    rows += [(200, None, "aa", 1, None), (201, "", None, 1, None), (202, "123 ...", "bb", 1, None), (203, "kalo", None, None, None), (204, "lo", "aa", 1, "")]
    rows += [(203, "kalo", None, None, None)]
    df = frame(rows, SCHEMA).repartition(5)
    learn = lambda i: i % 4 != 2
    got = predict(df, train(df, F.col("doc_id") % 4 != 2)).collect()
    expected = brute(rows, learn, 16)
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "text", "lang", "row", "lang_pred", "score"]
    for r in got:
        name, score = expected[r.doc_id]
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-4), r


def test_nothing_to_learn_and_nothing_to_predict(frame):
    rows = frame([(1, "text", None, 1, "")], SCHEMA)
    empty = frame([], SCHEMA)
    assert [(r.lang_pred, r.score) for r in predict(rows, train(rows, F.lit(True))).collect()] == [("und", 0.0)]
    assert predict(empty, train(empty, F.lit(True))).collect() == []


def test_too_many_languages_are_an_error(frame, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 4 << 13)
    with pytest.raises(ValueError, match="more than 2"):
        train(frame([(i, "a", f"l{i}", 0, "") for i in range(3)], SCHEMA), F.lit(True))


def test_fewer_buckets_for_more_languages(frame, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 4 << 14)
    model = train(frame([(i, "abc", f"l{i}", 0, "") for i in range(3)], SCHEMA), F.lit(True))
    assert model.bits == 12 and isinstance(model, LanguageModel) and np.allclose(np.exp(model.log_probability).sum(axis=0), 1, atol=1e-3)


def test_held_out_documents(spark, data_folder):
    documents = spark.read.parquet(f"{data_folder}/documents.parquet").select("doc_id", "lang")
    judged = op13_language_id(spark, data_folder).where("held_out").join(documents, "doc_id")
    right, n = judged.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95 * n
