"""Toxicity by noisy-channel deobfuscation.

1. A character language model: trigram counts over all texts of the corpus, counted in tasks and summed in Spark.
2. Words with digits, symbols, long repeats or spaced-out letters are lattices of what their writer may have meant. Viterbi
   decodes the most likely letters under the language model and the costs of the channel (leetspeak, inserted separators,
   repeated letters).
3. Restored words and their stems are scored by how surely labelled documents that hold them are toxic, and a logistic
   curve turns a document's strongest words into a score from 0 to 1.

Everything but the fit of the classifier (at most ``train_rows`` labelled documents, the ones with the smallest hashes)
covers the whole corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The alphabet of the language model (0 stands between words, OTHER is any letter not listed) and the letters
# that digits and symbols may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = " .-_*'’·~,:;/\\"
SIZE = 64
OTHER = 63
CLASS = {c: k + 1 for k, c in enumerate(LETTERS)}
_TABLE = np.zeros(0x250, np.int64)
for _point in range(0x250):
    _TABLE[_point] = CLASS.get(chr(_point), OTHER if chr(_point).isalpha() else 0)

# Costs of the channel, as negative logarithms of probabilities.
SUBSTITUTED, SEPARATED, REPEATED, KEPT_SYMBOL, PLAIN = 3.0, 2.5, 2.0, 6.0, 0.05

STEMS = (4, 5, 6)
SLICE = 1024
SCHEMA = "doc_id long, score double, restored array<struct<observed:string,restored:string>>"
_SPACED = r"(?:^|[^\pL\pN])[\pL\pN](?:[ .\-_*][\pL\pN]){3,}(?:[^\pL\pN]|$)"
_SPACED_PYTHON = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*][^\W_]){3,}(?![^\W_])")
_REPEAT = re.compile(r"(.)\1\1")
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_OUTER_LEET = re.compile(r"^[^\w@$!|+(€£]+|[^\w@$!|+(€£]+$")


def trigram_counts(documents: DataFrame, text_column: str = "text") -> np.ndarray:
    """How often each three characters (classes) follow each other in all texts; at most 64**3 numbers reach the driver."""

    def count(batches):
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                joined = "\n\n".join(t or "" for t in batch["text"].slice(at, 256).to_pylist()).lower()
                points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
                kinds = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], OTHER)
                if len(kinds) > 2:
                    codes = (kinds[:-2] * SIZE + kinds[1:-1]) * SIZE + kinds[2:]
                    total += np.bincount(codes, minlength=SIZE**3)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(total[full], pa.int64())], names=["code", "n"])

    rows = documents.select(F.col(text_column).alias("text")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE**3, np.int64)
    for r in rows.toLocalIterator():
        out[r["code"]] = r["n"]
    return out.reshape(SIZE, SIZE, SIZE)


def log_probabilities(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """log p(c | a, b), each order smoothed by the next lower one."""
    three = counts.astype(float)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + weight * p1) / (two.sum(1, keepdims=True) + weight)
    p3 = (three + weight * p2[None]) / (three.sum(2, keepdims=True) + weight)
    return np.log(p3).astype(np.float32)


def decode(word: str, logp: list) -> str:
    """The most likely letters behind an observed word, by Viterbi over the lattice of readings of each character."""
    # for the last two classes: the best path's score, and its letters as a chain from the last one back
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before = ""
    for c in word:
        kind = CLASS.get(c, OTHER if c.isalpha() else 0)
        readings = [(kind, c, PLAIN)] if kind else [(0, c, KEPT_SYMBOL)]
        for letter in LEET.get(c, ""):
            readings.append((CLASS[letter], letter, SUBSTITUTED))
        gone = min(SEPARATED if c in SEPARATORS else math.inf, REPEATED if c == before else math.inf)
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, chain) in states.items():
            for k, letter, cost in readings:
                new = score - cost + logp[a][b][k]
                if new > following.get((b, k), (-math.inf,))[0]:
                    following[b, k] = (new, (chain, letter))
            if gone < math.inf and score - gone > following.get((a, b), (-math.inf,))[0]:
                following[a, b] = (score - gone, chain)
        states, before = following, c
    (_, chain), letters = states[max(states, key=lambda s: states[s][0] + logp[s[0]][s[1]][0])], []
    while chain:
        chain, letter = chain
        letters.append(letter)
    return "".join(reversed(letters))


def suspicious(word: str) -> bool:
    """Letters together with digits or symbols, or a character three times in a row."""
    return not word.isalpha() and any(c.isalpha() for c in word) or bool(_REPEAT.search(word) and not word.isdigit())


@dataclass
class Model:
    """Strength of words and stems (a lower bound of the share of toxic documents among those that hold it), and the curve."""

    logp: np.ndarray
    strength: dict[str, float]
    weights: tuple[float, ...]


class _Reader:
    """Restored words of texts, each distinct word decoded once per process."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp.tolist()
        self.cache: dict[str, str] = {}

    def restore(self, word: str) -> str:
        out = self.cache.get(word)
        if out is None:
            out = decode(word, self.logp)
            if len(self.cache) < 50_000:
                self.cache[word] = out
        return out

    def forms(self, word: str) -> list[str]:
        """The word without outer punctuation, and its restored form where it is a lattice."""
        plain = _OUTER.sub("", word)
        out = [plain] if plain else []
        leet = _OUTER_LEET.sub("", word)
        for w in {plain, leet}:
            if w and suspicious(w):
                restored = self.restore(w)
                if restored and restored not in out:
                    out.append(restored)
        return out

    def words(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct lower-case words; their numbers in order; where each text starts. Spaced-out words count as words too."""
        texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        spaced = np.flatnonzero(pc.match_substring_regex(texts, _SPACED).to_numpy(zero_copy_only=False))
        codes = pc.utf8_split_whitespace(texts)
        offsets = codes.offsets.to_numpy() - codes.offsets[0].as_py()
        flat = codes.flatten().dictionary_encode()
        words, index = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        extra_words, extra_at = [], []
        for k in spaced:
            for m in _SPACED_PYTHON.finditer(texts[int(k)].as_py()):
                extra_words.append(m.group())
                extra_at.append(offsets[k + 1])
        if extra_words:
            index = np.insert(index, extra_at, np.arange(len(words), len(words) + len(extra_words)))
            offsets = offsets + np.searchsorted(np.array(extra_at), offsets, side="right")
            words += extra_words
        return words, index, offsets


def features(form: str) -> list[str]:
    """A word and its stems; stems are marked so that they are not taken for words."""
    return [form, *(f"{form[:n]}*" for n in STEMS if len(form) > n)]


def _per_text(reader: _Reader, texts: pa.Array, wanted: dict | None) -> list[set[str]]:
    words, index, offsets = reader.words(texts)
    by_word = [[f for form in reader.forms(w) for f in features(form) if wanted is None or f in wanted] for w in words]
    return [{f for k in set(index[a:b].tolist()) for f in by_word[k]} for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _counts(logp: np.ndarray):
    """How many toxic and other documents (y is 1 or 0) hold each feature."""

    def count(batches):
        reader = _Reader(logp)
        for batch in _slices(batches):
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for one, y in zip(_per_text(reader, batch["text"], None), batch["y"].to_pylist(), strict=True):
                found[y].update(one)
            names = list(found[0].keys() | found[1].keys())
            columns = [pa.array([found[y][f] for f in names], pa.int64()) for y in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], names=["feature", "hits", "misses"])

    return count


def lower_bound(hits: np.ndarray | Column, total: np.ndarray | Column, z: float = 2.0) -> np.ndarray | Column:
    """Wilson's lower bound of a share."""
    p = hits / total
    return (p + z * z / (2 * total) - z * (p * (1 - p) / total + z * z / (4 * total * total)) ** 0.5) / (1 + z * z / total)


def _strongest(reader: _Reader, strength: dict[str, float], texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """For each text: the strongest word, how many features have a strength over one half, and what was restored."""
    words, index, offsets = reader.words(texts)
    value, changed, strong = np.zeros(len(words)), {}, {}
    for k, w in enumerate(words):
        forms = reader.forms(w)
        known = {f: strength[f] for form in forms for f in features(form) if f in strength}
        if known:
            value[k], strong[k] = max(known.values()), [f for f, v in known.items() if v > 0.5]
        if len(forms) > 1 and value[k] > 0:
            changed[k] = {"observed": w, "restored": forms[-1]}
    best, many = np.zeros(len(texts)), np.zeros(len(texts))
    restored: list = [[] for _ in range(len(texts))]
    own = value[index]
    for t in np.unique(np.searchsorted(offsets, np.flatnonzero(own > 0), side="right") - 1):
        part = index[offsets[t] : offsets[t + 1]]
        distinct = np.unique(part[own[offsets[t] : offsets[t + 1]] > 0])
        best[t] = value[distinct].max()
        many[t] = len({f for k in distinct.tolist() for f in strong[k]})
        restored[t] = [changed[k] for k in distinct.tolist() if k in changed]
    return best, many, restored


def _slices(batches):
    """Parts of batches, so that the words of few texts are held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _inputs(best: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(best)), best, np.log1p(many)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's steps for a logistic curve with a ridge on all but the constant."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0, *[1.0] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty @ w)
    return w


def train(documents: DataFrame, labels: DataFrame, usable: Column, train_rows: int = 20_000, least: int = 3, most_features: int = 50_000) -> Model:
    """Fit on at most ``train_rows`` labelled documents that satisfy ``usable``.

    The curve is fitted on the same documents, each measured by the counts of all others. A feature needs ``least`` toxic documents
    and a strength of over twice the odds of a toxic label; the ``most_features`` strongest are kept. Labels that are null are
    ignored; of several labels of a document the highest counts. Without labels of both kinds every score is one half.
    """
    logp = log_probabilities(trigram_counts(documents))
    labels = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(usable).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    labels = labels.withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(train_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("text", "y")
    totals = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model(logp, {}, (0.0, 0.0, 0.0))
    counts = rows.where("y IN (0, 1)").select("text", F.col("y").cast("int").alias("y")).mapInArrow(_counts(logp), "feature string, hits long, misses long")
    counts = counts.groupBy("feature").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses")).where(F.col("hits") >= least)
    counts = counts.withColumn("bound", lower_bound(F.col("hits"), F.col("hits") + F.col("misses"))).where(F.col("bound") * totals[0] > 2 * totals[1] * (1 - F.col("bound")))
    kept = counts.orderBy(F.desc("bound"), "feature").limit(most_features).collect()
    strength = {r["feature"]: r["bound"] for r in kept}
    held = {r["feature"]: (r["hits"], r["misses"]) for r in kept}

    def measure(batches):
        reader = _Reader(logp)
        for batch in _slices(batches):
            best, many = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for k, (found, y) in enumerate(zip(_per_text(reader, batch["text"], held), batch["y"].to_pylist(), strict=True)):
                counts = np.array([held[f] for f in found], float).reshape(-1, 2) - [y, 1 - y]
                counts = counts[counts[:, 0] >= least]
                if len(counts):
                    own = lower_bound(counts[:, 0], counts.sum(1))
                    best[k], many[k] = own.max(), (own > 0.5).sum()
            yield pa.RecordBatch.from_arrays([pa.array(best), pa.array(many), batch["y"].cast(pa.float64())], names=["best", "many", "y"])

    seen = rows.select("text", F.col("y").cast("double").alias("y")).mapInArrow(measure, "best double, many double, y double").toPandas()
    weights = _logistic(_inputs(seen["best"].to_numpy(), seen["many"].to_numpy()), seen["y"].to_numpy()) if len(seen) else np.zeros(3)
    return Model(logp, strength, tuple(weights.tolist()))


def _score(model: Model):
    def score(batches):
        reader = _Reader(model.logp)
        for batch in _slices(batches):
            best, many, restored = _strongest(reader, model.strength, batch["text"])
            out = 1 / (1 + np.exp(-np.clip(_inputs(best, many) @ np.array(model.weights), -30, 30)))
            kind = pa.list_(pa.struct([("observed", pa.string()), ("restored", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.float64()), pa.array(restored, kind)], names=["doc_id", "score", "restored"])

    return score


def toxicity_scores(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the words whose restored form counted, one row per input row; null texts are empty."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(model), SCHEMA)


def keep_clean(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The documents that score under the threshold, all columns kept."""

    def clean(batches):
        reader = _Reader(model.logp)
        for batch in _slices(batches):
            best, many, _ = _strongest(reader, model.strength, batch["text"])
            out = 1 / (1 + np.exp(-np.clip(_inputs(best, many) @ np.array(model.weights), -30, 30)))
            yield batch.filter(pa.array(out < threshold))

    return documents.mapInArrow(clean, documents.schema)
