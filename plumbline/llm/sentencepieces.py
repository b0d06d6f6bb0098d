"""SentencePiece encoding by streaming Viterbi, and decoding.

Spaces become U+2581, one is put before a text that is not empty, and the best segmentation is the one whose pieces' scores
sum highest (the later start of the last piece wins no tie: the longer last piece does). A character that no piece starts
with is spelled by its byte pieces at a cost below all others. Decoding joins pieces and bytes and takes the first space
off again, so every text comes back as it was.

The encoder keeps only a window of the lattice: as many boundaries as the longest piece has characters. Ids are committed
whenever the backpointer paths of all boundaries in the window meet in one. No piece goes on with U+2581 after another
character, so the paths always meet before a word; the ids of a word are therefore kept and used again.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
#: Stands for a U+2581 of the text itself, which has to come back as one; no text can hold this code point.
LITERAL = "\ud800"
CACHE = 100_000
SLICE = 512
#: Characters of a word, with the mark before it, that is encoded together with others, and how many of these
#: are at a time; longer words are streamed.
LONGEST_WORD = 48
WORDS = 8192


class Pieces:
    """The pieces, scores and byte ids of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.text: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.text.append(piece.replace(MARK, " ").encode())
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces, so not every text could come back")
        self.longest = max(map(len, self.ids))
        # a tree of prefixes: [id or -1, score, next characters]
        self.root: dict[str, list] = {}
        for piece, i in self.ids.items():
            below, node = self.root, None
            for c in piece:
                node = below.setdefault(c, [-1, 0.0, {}])
                below = node[2]
            node[0], node[1] = i, self.score[piece]
        self.least = min(self.score.values()) - 10
        self.separate = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.cache: dict[str, list[int]] = {}
        # the same tree as edges (node, character) -> node in order, and the bytes of all pieces
        nodes, edges, todo = [-1], {}, [(0, self.root)]
        while todo:
            at, below = todo.pop()
            for c, (i, _, more) in below.items():
                edges[at << 21 | ord(c)] = len(nodes)
                todo.append((len(nodes), more))
                nodes.append(i)
        self.edges = np.array(sorted(edges), np.int64)
        self.nodes, self.node_ids = np.array([edges[k] for k in self.edges.tolist()], np.int64), np.array(nodes, np.int64)
        self.scores = np.zeros(len(self.text))
        self.scores[list(self.ids.values())] = [self.score[p] for p in self.ids]
        self.pool, self.sizes = pa.array(self.text, pa.binary()), np.array([len(t) for t in self.text], np.int64)

    def spelled(self, c: str) -> list[int]:
        return [self.bytes[b] for b in (MARK if c == LITERAL else c).encode()]

    def stream(self, characters: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters, given out as soon as they are certain.

        The window runs from the last certain boundary: the best sum of each boundary, the boundary before it on its path
        and the ids between the two. Paths are compared whenever no begun piece goes on, and once the window is as long
        as the longest piece.
        """
        root, longest = self.root, self.longest
        sums, before, between = [0.0], [0], [()]
        live: list[tuple[int, list]] = []  # boundaries at which pieces began that go on so far
        check = longest
        for c in characters:
            at = len(sums)
            best, start, ids, begun = -math.inf, at - 1, (), []
            for s, node in live:
                node = node[2].get(c)
                if node is not None:
                    begun.append((s, node))
                    if node[0] >= 0 and sums[s] + node[1] > best:
                        best, start, ids = sums[s] + node[1], s, (node[0],)
            node = root.get(c)
            if node is not None:
                begun.append((at - 1, node))
            if node is not None and node[0] >= 0:
                if sums[-1] + node[1] > best:
                    best, start, ids = sums[-1] + node[1], at - 1, (node[0],)
            elif sums[-1] + self.least > best:
                best, start, ids = sums[-1] + self.least, at - 1, self.spelled(c)
            sums.append(best)
            before.append(start)
            between.append(ids)
            live = begun
            if live and at < check:
                continue
            heads = {at, *(s for s, _ in live)}
            while len(heads) > 1:
                last = max(heads)
                heads.remove(last)
                heads.add(before[last])
            meet = heads.pop()
            if meet:
                yield from self._path(before, between, meet)
                # what lies before the meeting point is done with
                sums, between = sums[meet:], between[meet:]
                before = [max(0, k - meet) for k in before[meet:]]
                live = [(s - meet, node) for s, node in live]
            check = len(sums) - 1 + longest
        yield from self._path(before, between, len(sums) - 1)

    @staticmethod
    def _path(before: list[int], between: list, end: int) -> list[int]:
        parts = []
        while end > 0:
            parts.append(between[end])
            end = before[end]
        return [i for part in reversed(parts) for i in part]

    def word(self, word: str) -> list[int]:
        out = self.cache.get(word)
        if out is None:
            out = list(self.stream(word))
            if len(self.cache) < CACHE:
                self.cache[word] = out
        return out

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        marked = MARK + text.replace(MARK, LITERAL).replace(" ", MARK)
        if not self.separate:
            return list(self.stream(marked))
        return [i for w in re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked) for i in self.word(w)]

    def decode(self, ids: Iterable[int]) -> str:
        text = self.text
        return b"".join([text[i] for i in ids]).decode("utf-8", "replace")[1:]

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many words, one after the other, and how many each has: all their lattices at once.

        The paths of a word meet where it ends, so its window is the word itself. Every piece that starts at any character
        is found by going down the tree of prefixes together, and boundaries are settled in the order of their places.
        A character that no piece spells is a piece by itself, put in bytes at the end.
        """
        sizes = pc.utf8_length(words).to_numpy().astype(np.int64) + 1
        codes = np.frombuffer("".join(MARK + w for w in words.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        first = np.repeat(ends - sizes, sizes)
        last = np.repeat(ends, sizes)
        start, node, reach = np.arange(len(codes)), np.zeros(len(codes), np.int64), np.arange(len(codes))
        single = np.zeros(len(codes), bool)
        found = []
        for length in range(1, self.longest + 1):
            key = node << 21 | codes[reach]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            on = self.edges[at] == key
            start, node = start[on], self.nodes[at[on]]
            piece = self.node_ids[node]
            whole = piece >= 0
            found.append((start[whole], np.full(int(whole.sum()), length), piece[whole]))
            if length == 1:
                single[start[whole]] = True
            reach = start + length
            on = reach < last[start]
            start, node, reach = start[on], node[on], reach[on]
            if not len(start):
                break
        odd, number = np.unique(codes[~single], return_inverse=True)
        found.append((np.flatnonzero(~single), np.ones(len(number), np.int64), len(self.scores) + number))
        begins, lengths, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        scores = np.concatenate([self.scores, np.full(len(odd), self.least)])
        place = begins - first[begins] + lengths
        # boundaries in order, and at each the longer pieces first, which win ties
        order = np.lexsort((-lengths, place))
        begins, lengths, ids, place = begins[order], lengths[order], ids[order], place[order]
        word = np.repeat(np.arange(len(sizes)), sizes)
        best, back, took = np.full(len(codes) + len(sizes), -np.inf), np.zeros(len(codes) + len(sizes), np.int64), np.zeros(len(codes) + len(sizes), np.int64)
        best[ends - sizes + np.arange(len(sizes))] = 0.0
        begins = begins + word[begins]  # a word has one more boundary than characters
        for part in np.split(np.arange(len(begins)), np.flatnonzero((np.diff(place) != 0) | (np.diff(lengths) != 0)) + 1) if len(begins) else []:
            s = begins[part]
            to, sums = s + lengths[part[0]], best[s] + scores[ids[part]]
            better = sums > best[to]
            best[to[better]], back[to[better]], took[to[better]] = sums[better], s[better], ids[part[better]]
        at, zero = ends + np.arange(len(sizes)), ends - sizes + np.arange(len(sizes))
        steps, who = [], np.arange(len(sizes))
        while len(who):
            steps.append((who, took[at[who]]))
            at[who] = back[at[who]]
            who = who[at[who] > zero[who]]
        owner, values = (np.concatenate(x)[::-1] for x in zip(*steps, strict=True)) if steps else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(owner, kind="stable")
        owner, values = owner[order], values[order]
        if len(odd):
            spelled = [self.spelled(chr(c)) for c in odd.tolist()]
            extra = np.array([len(x) for x in spelled])
            bytewise = values >= len(self.scores)
            repeats = np.ones(len(values), np.int64)
            repeats[bytewise] = extra[values[bytewise] - len(self.scores)]
            inserted = [i for v in values[bytewise].tolist() for i in spelled[v - len(self.scores)]]
            bytewise, owner, values = (np.repeat(x, repeats) for x in (bytewise, owner, values))
            values[bytewise] = inserted
        return values.astype(np.int32), np.bincount(owner, minlength=len(sizes))

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The ids of every text; words that recur in the batch are looked up once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pc.invert(pc.match_substring_regex(texts, f"^$|^ |  |{MARK}")).to_numpy(zero_copy_only=False) & self.separate
        # other texts count as one word of their own
        slow = [np.array(self.encode(texts[int(k)].as_py()), np.int32) for k in np.flatnonzero(~plain)]
        split = pc.split_pattern(pc.if_else(pa.array(plain), texts, ""), " ")
        codes = split.flatten().dictionary_encode()
        known = codes.dictionary
        long = pc.utf8_length(known).to_numpy() >= LONGEST_WORD
        short = pc.if_else(pa.array(long), "", known)
        done = [self.words(short.slice(at, WORDS)) for at in range(0, max(1, len(known)), WORDS)]
        flat, lengths = (np.concatenate(x) for x in zip(*done, strict=True))
        if long.any():
            # in the place of the empty words that stood for them
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            for k in np.flatnonzero(long):
                parts[k] = np.fromiter(self.stream(MARK + known[int(k)].as_py()), np.int32)
            flat, lengths = np.concatenate(parts), np.array([len(x) for x in parts])
        index, offsets = codes.indices.to_numpy().astype(np.int64), split.offsets.to_numpy() - split.offsets[0].as_py()
        index[offsets[:-1][~plain]] = len(lengths) + np.arange(len(slow))
        flat = np.concatenate([flat, *slow])
        lengths = np.concatenate([lengths, np.array([len(x) for x in slow], np.int64)]).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        took = lengths[index]
        sums = np.concatenate([[0], np.cumsum(took)])
        ids = flat[np.repeat(starts[index] - sums[:-1], took) + np.arange(int(sums[-1]))]
        return pa.ListArray.from_arrays(pa.array(sums[offsets], pa.int32()), pa.array(ids, pa.int32()))

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The text of every list of ids: their bytes, gathered and joined without a step per id."""
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        ids = pc.list_flatten(lists).to_numpy()
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
        content = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), self.pool.take(pa.array(ids))), b"")[0].as_buffer() if len(ids) else b""
        view, null = memoryview(content), lists.is_null().to_pylist()
        out = [None if gone else str(view[a:b], "utf-8", "replace")[1:] for a, b, gone in zip(ends[:-1].tolist(), ends[1:].tolist(), null, strict=True)]
        return pa.array(out, pa.string())


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One set of pieces per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _added(path: str, source: str, target: str, step: str):
    def add(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                column = getattr(pieces(path), step)(part[part.schema.get_field_index(source)])
                kept = [(n, c) for n, c in zip(part.schema.names, part.columns, strict=True) if n != target]
                yield pa.RecordBatch.from_arrays([*(c for _, c in kept), column], names=[*(n for n, _ in kept), target])

    return add


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(documents: DataFrame, model_path: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """documents with the ids of each text; a null or empty text has none. A column named like the new one is replaced."""
    schema = _with(documents, ids_column, T.ArrayType(T.IntegerType()))
    return documents.mapInArrow(_added(model_path, text_column, ids_column, "encode_all"), schema)


def decode(encoded: DataFrame, model_path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """encoded with the text of each list of ids; a null list has a null text. A column named like the new one is replaced."""
    schema = _with(encoded, text_column, T.StringType())
    return encoded.mapInArrow(_added(model_path, ids_column, text_column, "decode_all"), schema)
