"""Toxicity: restored words, held-out accuracy and defined results for odd rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import toxicity

BAD = ["blistering", "numbskull", "wretched"]
SYLLABLES = "ba lo mi tur en sha kel ro vin da".split()


def words(n):
    return ["".join(random.choice(SYLLABLES) for _ in range(random.randint(1, 3))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    random.seed(14)
    rows, labels = [], []
    for d in range(700):
        text, toxic = words(random.randint(3, 60)), int(d % 4 == 0)
        if toxic:
            text.insert(random.randint(0, len(text)), random.choice(BAD))
        rows.append((d, " ".join(text), 0.5))
        if d < 600:
            labels.append((d, toxic))
    labels += [(1, 0), (None, 1), (2, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score double")
    return documents, toxicity.train(documents, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 5 != 0)


def test_words_are_restored(corpus):
    reader = toxicity._Reader(corpus[1].logp)
    for observed in ("numb5kull", "n.u.m.b.s.k.u.l.l", "numbskuuuulll", "b1i5tering", "wr3tch3d", "n u m b s k u l l", "wretch€d"):
        got = reader.restore(observed)
        assert got in BAD, (observed, got)
    assert not toxicity.suspicious("2024") and toxicity.suspicious("w0rd")


def test_held_out_scores(corpus):
    documents, model = corpus
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(documents, model).collect()}
    held = [d for d in got if d >= 600 or d % 5 == 0]
    assert all((got[d] >= 0.7) == (d % 4 == 0) for d in held)
    assert all(0 <= s <= 1 for s in got.values())


def test_obfuscated_odd_and_clean_rows(spark, corpus):
    _, model = corpus
    rows = [(1, "BA lo w-r-e-t-c-h-e-d mi"), (2, "lo N u m b s k u l l ro"), (3, None), (4, ""), (5, "b1i5tering"), (None, "lo ba mi"), (6, "x" * 50_000), (6, "a1" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity_scores(df, model).collect()
    assert [r.score >= 0.7 for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))] == [True, True, False, False, True, False, False, False]
    assert {r.doc_id: r.restored for r in got}[5][0].restored == "blistering"
    kept = toxicity.keep_clean(df, model).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 3, 4, 6, 6]


def test_empty_table_and_one_sided_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    model = toxicity.train(empty, labels, F.lit(True))
    assert toxicity.toxicity_scores(empty, model).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert toxicity.toxicity_scores(one, model).first().score == 0.5


@pytest.mark.parametrize("tenths", [5, 7])
def test_mostly_toxic_labels(spark, tenths):
    random.seed(15)
    rows, labels = [], []
    for d in range(500):
        text, toxic = words(random.randint(3, 40)), int(d % 10 < tenths)
        rows.append((d, " ".join(text + [random.choice(BAD)] * toxic)))
        labels.append((d, toxic))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(documents, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") < 400)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(documents, model).collect()}
    assert all((got[d] >= 0.7) == (d % 10 < tenths) for d in range(400, 500))


def test_strong_words_are_kept_before_frequent_ones(spark, corpus):
    labels = spark.createDataFrame([(d, int(d % 4 == 0)) for d in range(600)], "doc_id long, toxic int")
    model = toxicity.train(corpus[0], labels, F.lit(True), most_features=2)
    assert len(model.strength) == 2 and all(any(b.startswith(f.rstrip("*")) for b in BAD) for f in model.strength)
