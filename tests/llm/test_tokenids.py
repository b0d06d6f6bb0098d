"""Token files: ids as the tokenizers library gives them, and an exact round trip."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import tokenids
from plumbline.llm.eliasfano import EliasFano, encode
from plumbline.llm.queries import tokenizer_path

BITS = ["a", "Bc", " ", "  ", "\n", "\t", " \n", "\n ", "é", "日本", "1", "23", "'s", "'ll", "!", "...", "😀", " ", " ", "\x85", "\x0b", "<|endoftext|>", "ª", "x1", "don't", "́", ",", "."]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def texts(n):
    random.seed(n)
    return ["".join(random.choice(BITS) for _ in range(random.randint(0, 14))) for _ in range(n)]


def test_pieces_give_the_ids_of_whole_texts(library):
    own = [*texts(3000), None, "", " ", "  ", " a", "a "]
    ids, counts = tokenids.encoder(tokenizer_path("byte_bpe_50k.json")).encode(pa.array(own, pa.string()), 0)
    wanted = [[*e.ids, 0] for e in library.encode_batch([t or "" for t in own], add_special_tokens=False)]
    assert counts.tolist() == list(map(len, wanted)) and ids.tolist() == [i for w in wanted for i in w]


def test_round_trip_through_files(frame, library, monkeypatch):
    monkeypatch.setattr(tokenids, "PARTITION_BYTES", 800)
    monkeypatch.setattr(tokenids, "FILE_IDS", 60)
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 100)
    rows = [(i * 7 - 300, t) for i, t in enumerate(texts(150))] + [(1 << 40, "a b"), (1000, None), (1001, "")]
    random.shuffle(rows)
    got = tokenids.round_trip(frame(rows, "doc_id long, text string"), tokenizer_path("byte_bpe_50k.json")).collect()
    wanted, start = [], 0
    for i, t in sorted(rows):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got)) == wanted


def test_nulls_repeats_and_empty_tables(frame):
    path = tokenizer_path("byte_bpe_50k.json")
    got = tokenids.round_trip(frame([(None, "x"), (5, "b"), (5, "a"), (None, None), (5, "b")], "doc_id long, text string"), path).collect()
    assert sorted(r.start for r in got) == [0, 1, 3, 5, 7] or sorted(r.start for r in got) == [0, 2, 3, 5, 7]
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, 5, 5, 5]
    assert tokenids.round_trip(frame([], "doc_id long, text string"), path).collect() == []


def test_a_file_gives_single_documents():
    ids = np.arange(30, dtype=np.uint32) + 70_000
    f = tokenids.TokenFile(tokenids.file_bytes(3, 0, 9, [None, 4, 8, 8], ids, np.array([0, 10, 15, 5])))
    assert (f.partition, f.before, f.nameless) == (3, 9, 1)
    assert [f.document(k).tolist() for k in range(4)] == [[], ids[:10].tolist(), ids[10:25].tolist(), ids[25:].tolist()]
    assert f.names.values().tolist() == [4, 8, 8]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**62), 2**62 - 1) | st.integers(0, 3000), max_size=900).map(sorted))
def test_elias_fano(values):
    read = EliasFano(b"xx" + encode(np.array(values, np.int64)), 2)
    assert read.values().tolist() == values
    assert [read.select(k) for k in range(0, len(values), 7)] == values[::7]


def test_elias_fano_takes_little_space():
    ends = np.cumsum(np.random.default_rng(1).integers(100, 900, 50_000))
    assert len(encode(ends)) < 50_000 * 12 / 8


class Counting:
    """A tokenizer that counts the texts given to it, single words included."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.texts = tokenizer, self, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)

    def tokenize(self, word):
        self.texts += 1
        return self.tokenizer.model.tokenize(word)


def test_new_words_reach_the_library_together(library, monkeypatch):
    monkeypatch.setattr(tokenids, "CACHE", 700)
    random.seed(5)
    own = [" ".join("".join(random.choices("abcdeé1.,'\n", k=random.randint(1, 9))).strip() or "x" for _ in range(100)) for _ in range(90)]
    encoder = tokenids.Encoder(tokenizer_path("byte_bpe_50k.json"))
    encoder.tokenizer = Counting(encoder.tokenizer)
    for some in (own[:30], own[30:60], own[20:]):
        ids, counts = encoder.encode(pa.array(some, pa.string()), 0)
        wanted = [[*e.ids, 0] for e in library.encode_batch(some, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, wanted)) and ids.tolist() == [i for w in wanted for i in w]
    # the first words of the texts and a few joined ones, not some 7,000 words
    assert encoder.tokenizer.texts < 200


def test_words_joined_in_small_texts(library, monkeypatch):
    monkeypatch.setattr(tokenids, "JOINED_BYTES", 5)
    own = [*texts(500), "aa bb cccccccccc d éé f", "\n a", " b\n", "x\n y", "a\nb c\td"]
    ids, counts = tokenids.Encoder(tokenizer_path("byte_bpe_50k.json")).encode(pa.array(own, pa.string()), 0)
    wanted = [[*e.ids, 0] for e in library.encode_batch(own, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, wanted)) and ids.tolist() == [i for w in wanted for i in w]


def test_slices_span_batches_and_keep_every_row(monkeypatch):
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 100)
    own = [(i, None if i % 5 == 0 else "x" * (i * 37 % 140)) for i in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in own[k : k + 4]], pa.int64()), pa.array([t for _, t in own[k : k + 4]], pa.string())], names=["doc_id", "text"]) for k in range(0, 60, 4)]
    got = [(names, texts.to_pylist()) for names, texts in tokenids._slices(iter(batches))]
    assert [r for names, some in got for r in zip(names, some, strict=True)] == own
    assert all(len(some) == 1 or sum(len(t or "") + 8 for t in some) <= 100 for _, some in got)
    tiny = [pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array(["a"])], names=["doc_id", "text"]) for i in range(22)]
    assert [names for names, _ in tokenids._slices(iter(tiny))] == [[*range(11)], [*range(11, 22)]]


def test_only_short_words_are_kept(library):
    own = ["a bb " + "c" * 33 + " d\n", "日本語の長い文" * 9, "e" * 32 + " " + "f" * 32 + " bb"]
    encoder = tokenids.Encoder(tokenizer_path("byte_bpe_50k.json"))
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(own, pa.string()), 0)
        wanted = [[*e.ids, 0] for e in library.encode_batch(own, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, wanted)) and ids.tolist() == [i for w in wanted for i in w]
    assert sorted(encoder.known.to_pylist()) == ["bb", "f" * 32]
