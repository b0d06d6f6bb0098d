"""Streaming Viterbi against the whole lattice, and exact round trips."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from plumbline.llm import sentencepieces
from plumbline.llm.queries import tokenizer_path
from plumbline.llm.sentencepieces import LITERAL, MARK

PATH = tokenizer_path("piece_bpe_32k.model")
BITS = ["a", "the ", "é", "日", "▁", "  ", " ", "\n", "ing", "😀", "x", "ß", "1", ".", "ation ", "\t"]


@pytest.fixture(scope="module")
def model():
    return sentencepieces.pieces(PATH)


def marked(text):
    return MARK + text.replace(MARK, LITERAL).replace(" ", MARK) if text else ""


def whole_lattice(model, text):
    text = marked(text)
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        found = None
        for start in range(max(0, end - model.longest), end):
            piece = text[start:end]
            if piece in model.ids:
                new = (best[start][0] + model.score[piece], best[start][1] + [model.ids[piece]])
            elif start == end - 1:
                new = (best[start][0] + model.least, best[start][1] + model.spelled(piece))
            else:
                continue
            found = new if found is None or new[0] > found[0] else found
        best.append(found)
    return best[-1][1]


def texts(n):
    random.seed(n)
    return ["".join(random.choice(BITS) for _ in range(random.randint(0, 25))) for _ in range(n)]


def test_streams_give_the_best_path(model):
    for text in texts(800):
        assert list(model.stream(marked(text))) == model.encode(text) == whole_lattice(model, text)


def test_ids_come_before_the_stream_ends(model):
    taken = []

    def characters():
        for c in marked("word " * 50):
            taken.append(c)
            yield c

    stream = model.stream(characters())
    next(stream)
    assert len(taken) <= 2 * model.longest


def test_columns_round_trip(frame, model):
    own = [*texts(200), None, "", " ", "a ", "x" * 50_000]
    assert model.encode_all(pa.array(own)).to_pylist() == [model.encode(t or "") for t in own]
    rows = [(k, t, "kept") for k, t in enumerate(own)]
    df = sentencepieces.decode(sentencepieces.encode(frame(rows, "doc_id long, text string, ids string"), PATH), PATH)
    assert df.columns == ["doc_id", "text", "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in df.collect())
    assert sentencepieces.encode(frame([], "doc_id long, text string"), PATH).collect() == []
