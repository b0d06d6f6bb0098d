"""Benchmark decontamination: n-gram seeds join documents to test items, and Smith-Waterman scores edited copies.

1. Every n-gram of the test items is counted over all documents (document frequency).
2. The seeds of an item are all of its n-grams that occur in a document, whichever an edited copy has left whole. Only an
   n-gram that is far more frequent than the item's others, such as a common phrase, is no seed.
3. Documents are joined to items by seeds. Around any seed the words of the document are aligned with those of the item,
   unless too few of the item's words are there to reach the threshold; the score is that of the best local alignment, as
   a share of a perfect one.

Both passes read the documents once and shuffle no text. Items are taken in blocks of a bounded number of words; each
block is sent to all tasks.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import cells

SCHEMA = "doc_id long, item_id long, score double, start int, end int, passage string"
MATCH, MISMATCH, GAP = 2, -1, 1
BLOCK_WORDS = 200_000
#: An n-gram in more documents than this, and in so many times more than the median one of its item, is no seed.
FREQUENT, FREQUENT_TIMES = 1000, 20
#: Lower-case letters and digits stay, other ASCII characters part words.
_PLAIN = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_PLAIN).split()


class _Texts:
    """The hashes of all words of a batch, and of its n-grams; grams never reach over the end of a text."""

    def __init__(self, texts: list[str | None], n: int):
        words, lengths = [], []
        for t in texts:
            own = words_of(t)
            lengths.append(len(own))
            words += own
        self.hashes = cells.word_hashes(words)
        self.ends = np.cumsum([0, *lengths])
        grams = cells.window_hashes(self.hashes, n)
        self.owner = np.repeat(np.arange(len(lengths)), lengths)[: len(grams)]
        self.inside = np.arange(len(grams)) + n <= self.ends[1:][self.owner] if len(grams) else np.zeros(0, bool)
        self.grams = grams


def _found(grams: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of grams that are among ascending known ones, and their numbers there."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    hit = np.flatnonzero(known[at] == grams)
    return hit, at[hit]


def document_frequency(documents: DataFrame, known: np.ndarray, n: int) -> np.ndarray:
    """In how many texts each of the known n-grams occurs."""

    def count(batches):
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                t = _Texts(batch["text"].slice(at, 1024).to_pylist(), n)
                hit, gram = _found(t.grams, known)
                ok = t.inside[hit]
                pairs = np.unique(np.stack([t.owner[hit[ok]], gram[ok]]), axis=1)
                total += np.bincount(pairs[1], minlength=len(known))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(total[full], pa.int64())], names=["gram", "n"])

    rows = documents.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(len(known), np.int64)
    for r in rows.collect():  # one row per n-gram of a block of items
        out[r["gram"]] = r["n"]
    return out


def seeds(frequency: np.ndarray) -> np.ndarray:
    """Of an item's n-grams in order, which ones are seeds: all that occur, but those far more frequent than the others."""
    live = frequency > 0
    usual = np.median(frequency[live]) if live.any() else 0
    return live & (frequency <= max(FREQUENT, FREQUENT_TIMES * usual))


def align(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best local alignment's score and its first and last word (exclusive) in the part."""
    slope = GAP * np.arange(len(part) + 1)
    table = np.zeros((len(item) + 1, len(part) + 1), np.int32)
    for i, word in enumerate(item):
        diagonal = table[i, :-1] + np.where(part == word, MATCH, MISMATCH)
        best = np.maximum(np.maximum(diagonal, table[i, 1:] - GAP), 0)
        # a gap in the item may follow any cell to the left
        table[i + 1, 1:] = np.maximum.accumulate(best + slope[1:]) - slope[1:]
    i, j = np.unravel_index(int(np.argmax(table)), table.shape)
    score, end = int(table[i, j]), int(j)
    while i and j and table[i, j]:
        if table[i, j] == table[i - 1, j - 1] + (MATCH if item[i - 1] == part[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] - GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end


class _Matcher:
    """Finds the passages of a block of items in batches of documents."""

    def __init__(self, items: dict[int, np.ndarray], places: dict[int, list[tuple[int, int]]], known: np.ndarray, n: int, threshold: float):
        self.items, self.places, self.known, self.n, self.threshold = items, places, known, n, threshold

    def _stretches(self, own: list[tuple[int, int]], size: int):
        """Parts of a document around seeds of one item whose distances agree with the item's."""
        own.sort(key=lambda x: x[0] - x[1])
        slack = max(3, size // 4)
        group: list[tuple[int, int]] = []
        for place, at in [*own, (1 << 60, 0)]:
            if group and place - at - (group[-1][0] - group[-1][1]) > slack:
                yield min(p - a for p, a in group) - slack, max(p - a for p, a in group) + size + slack
                group = []
            group.append((place, at))

    def find(self, texts: list[str | None]) -> list[tuple]:
        """(row, item, score, first word, last word, passage) of the best alignment of every row and item that has seeds."""
        t = _Texts(texts, self.n)
        hit, gram = _found(t.grams, self.known)
        ok = t.inside[hit]
        hits: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for place, g, row in zip(hit[ok].tolist(), gram[ok].tolist(), t.owner[hit[ok]].tolist(), strict=True):
            for item, where in self.places[g]:
                hits[row, item].append((place, where))
        out = []
        for (row, item), own in hits.items():
            size, start, stop = len(self.items[item]), int(t.ends[row]), int(t.ends[row + 1])
            best = (0.0, 0, 0)
            for first, last in self._stretches(own, size):
                first, last = max(first, start), min(last, stop)
                # each word of the item adds at most one match
                if np.isin(self.items[item], t.hashes[first:last]).sum() / size < self.threshold:
                    continue
                score, a, b = align(self.items[item], t.hashes[first:last])
                best = max(best, (score / (MATCH * size), first + a - start, first + b - start))
            if best[0] >= self.threshold:
                out.append((row, item, *best, b" ".join(words_of(texts[row])[best[1] : best[2]]).decode("utf-8", "replace")))
        return out

    def rows(self, batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                if out := self.find(part["text"].to_pylist()):
                    row, *rest = zip(*out, strict=True)
                    kinds = (pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.string())
                    columns = [part["doc_id"].take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "score", "start", "end", "passage"])

    def without(self, batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keep = np.ones(part.num_rows, bool)
                keep[[x[0] for x in self.find(part["text"].to_pylist())]] = False
                yield part.filter(pa.array(keep))


def _blocks(benchmark: DataFrame):
    """Test items as word hashes, in blocks of at most BLOCK_WORDS words (or one item)."""
    block: dict[int, np.ndarray] = {}
    held = 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        words = cells.word_hashes(words_of(r["text"]))
        if block and (held + len(words) > BLOCK_WORDS or r["item_id"] in block):
            yield block
            block, held = {}, 0
        block[r["item_id"]] = words
        held += len(words)
    if block:
        yield block


def _matchers(documents: DataFrame, benchmark: DataFrame, n: int, threshold: float):
    for items in _blocks(benchmark):
        grams = {i: cells.window_hashes(w, n) for i, w in items.items() if len(w) >= n}
        known = np.unique(np.concatenate(list(grams.values()))) if grams else np.zeros(0, np.uint64)
        if not len(known):
            continue
        frequency = document_frequency(documents, known, n)
        by_gram: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, own in grams.items():
            number = np.searchsorted(known, own)
            for at in np.flatnonzero(seeds(frequency[number])).tolist():
                by_gram[int(number[at])].append((item, at))
        used = np.array(sorted(by_gram), np.int64)
        yield _Matcher(items, {k: by_gram[g] for k, g in enumerate(used.tolist())}, known[used], n, threshold)


def contaminated(documents: DataFrame, benchmark: DataFrame, n: int = 3, threshold: float = 0.5) -> DataFrame:
    """doc_id, item_id, score (0 to 1), first and last word (exclusive) of the passage, and the passage's words.

    One row per document row and item whose best alignment reaches the threshold. Words are lower-case runs of letters
    and digits. Items with fewer than n words and rows whose text or item_id is null find nothing; an empty table gives
    no rows. Documents that repeat an identifier each give their rows. Other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.sparkSession.createDataFrame([], SCHEMA)
    for matcher in _matchers(rows, benchmark, n, threshold):
        found = found.union(rows.mapInArrow(matcher.rows, SCHEMA))
    return found


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, n: int = 3, threshold: float = 0.5) -> DataFrame:
    """The documents without a contaminated passage, all columns kept."""
    kept = documents
    for matcher in _matchers(documents.select("text"), benchmark, n, threshold):
        kept = kept.mapInArrow(matcher.without, documents.schema)
    return kept
