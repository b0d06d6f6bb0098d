"""Substring dedup: repeated token windows are removed from every document but those with the smallest identifier.

A window is ``width`` consecutive words. Its Rabin-Karp hash is looked up among the hashes of all windows of the corpus
(`cells`): a word goes if a window that covers it also starts in a document with a smaller identifier. Overlapping
windows merge into maximal removal intervals. Windows are judged on the input, so the result does not depend on any order
of removal. Two different windows are taken as equal only if their 64-bit hashes are.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import cells

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"


class _Windows:
    """All windows of the documents of a chunk, the documents in ascending order of their identifiers."""

    def __init__(self, table: pa.Table, width: int):
        table = table.sort_by([("doc_id", "ascending")])
        self.ids = table["doc_id"].to_pylist()
        self.texts = [b"" if t is None else t for t in table["text"].cast(pa.binary()).to_pylist()]
        lengths, hashes, batch = [], [np.zeros(0, np.uint64)], []
        for text in self.texts:
            words = text.split()
            lengths.append(len(words))
            batch += words
            if len(batch) > 100_000:
                hashes.append(cells.word_hashes(batch))
                batch = []
        hashes.append(cells.word_hashes(batch))
        self.ends = np.cumsum([0, *lengths])
        lengths = np.array(lengths, np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        rolled = cells.window_hashes(np.concatenate(hashes), width)
        start = np.arange(len(rolled))
        known = np.array([i is not None for i in self.ids], bool)
        inside = (start + width <= self.ends[1:][owner[: len(rolled)]]) & known[owner[: len(rolled)]] if len(rolled) else np.zeros(0, bool)
        self.start = start[inside]
        self.doc = np.array([0 if i is None else i for i in self.ids], np.int64)[owner[: len(rolled)][inside]]
        self.distinct, first, self.entry = np.unique(rolled[inside], return_index=True, return_inverse=True)
        self.least = self.doc[first]


def _send(width: int, buckets: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        w = _Windows(table, width)
        return cells.cells(key[0].as_py(), w.distinct, w.least, buckets)

    return send


def _judge(table: pa.Table) -> pa.Table:
    """Bits for windows whose smallest document of all chunks is smaller than the chunk's."""
    hashes, least, lengths = cells.gathered(table)
    least = least.view(np.int64)
    order = np.argsort(hashes, kind="stable")
    runs = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
    smallest = np.empty_like(least)
    smallest[order] = np.repeat(np.minimum.reduceat(least[order], runs), np.diff(runs, append=len(order)))
    return cells.flagged(table, smallest < least, lengths)


def _remove(width: int, buckets: int):
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        w = _Windows(left, width)
        gone = cells.flags_of(right, w.distinct, buckets)[w.entry] | (w.doc > w.least[w.entry])
        at = w.start[gone]
        depth = np.zeros(w.ends[-1] + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + width, -1)
        covered = np.cumsum(depth)[:-1] > 0
        kept, removed, n_removed = [], [], []
        for k, text in enumerate(w.texts):
            words = text.split()
            out = covered[w.ends[k] : w.ends[k + 1]]
            n = int(out.sum())
            n_removed.append(n)
            kept.append(b" ".join(itertools.compress(words, ~out) if n else words))
            edges = np.flatnonzero(np.diff(out, prepend=False, append=False)) if n else np.zeros(0, int)
            removed.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        return pa.table(
            {
                "doc_id": pa.array(w.ids, pa.int64()),
                "n_words": pa.array(np.diff(w.ends), pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            }
        )

    return remove


def remove_repeats(documents: DataFrame, width: int = 13, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) and the removal intervals in words.

    One row per input row. A null or empty text has no words. Rows of the same identifier do not remove each other's
    words. A null identifier is neither smaller nor larger than others: such a row is kept whole and removes nothing.
    Documents shorter than a window are kept whole. Other columns are ignored, whatever their names.
    """
    chunks, buckets = cells.sizes(documents, text_column)
    dealt = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    dealt = dealt.withColumn("chunk", cells.chunk_of(chunks, "doc_id", "text"))
    sent = dealt.groupBy("chunk").applyInArrow(_send(width, buckets), cells.CELL_SCHEMA)
    flags = sent.groupBy("bucket").applyInArrow(_judge, cells.FLAG_SCHEMA)
    return dealt.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(_remove(width, buckets), SCHEMA)
