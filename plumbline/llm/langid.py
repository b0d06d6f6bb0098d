"""Language identification by multinomial naive Bayes over hashed character n-grams.

A text becomes its letters in lower case, every run of other characters one space. Its n-grams of one to three characters,
none of which reaches over a space, are hashed into buckets. Tasks count the buckets of all learnable texts by language
and Spark sums the counts; the log-probabilities (languages x buckets, of a checked size) are broadcast. A batch of texts
is a sparse matrix of documents x buckets in compressed rows, which numpy multiplies with the log-probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
LEAST_BUCKET_BITS = 12
#: Bytes that the log-probabilities may take; more languages get fewer buckets.
MODEL_BYTES = 64 << 20
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Characters that a task turns into n-grams at a time, and languages whose counts it holds.
SLICE_CHARACTERS = 1 << 19
HELD_LANGUAGES = 32

_SPACE = np.uint32(32)
#: Odd multipliers that spread the bits of a code point.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point whether it is a letter; made once per worker."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, log P(language), and log P(bucket | language) as buckets x languages."""

    languages: tuple[str, ...]
    prior: np.ndarray
    log_probability: np.ndarray

    @property
    def bits(self) -> int:
        return int(self.log_probability.shape[0]).bit_length() - 1


def cut(text: str, size: int = SLICE_CHARACTERS) -> list[str]:
    """Parts of at most ``size`` characters, ended after a space where there is one."""
    parts, at = [], 0
    while len(text) - at > size:
        end = text.rfind(" ", at, at + size) + 1 or at + size
        parts.append(text[at:end])
        at = end
    return [*parts, text[at:]]


def ngrams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse rows of some texts: bucket numbers, where the buckets of each text start, and whether it has a letter."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    codes = np.frombuffer((" " + " ".join(lowered) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum(sizes + 1) - sizes - 1  # the space before each text
    letter = letters()[np.minimum(codes, 0x10FFFF)]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[first] = True
    place = np.cumsum(keep) - 1
    starts, has_letter = place[first], np.add.reduceat(letter, first, dtype=np.int64) > 0
    letter = letter[keep]
    codes = np.where(letter, codes[keep], _SPACE).astype(np.uint32)
    n, shift, hashed, valid = len(codes), np.uint32(32 - bits), [], []
    mixed = np.zeros(n, np.uint32)
    inside = np.ones(n, bool)
    for k, factor in enumerate(_FACTORS[: max(ORDERS)]):
        ahead = codes[k:]
        mixed = (mixed[: len(ahead)] ^ ahead) * factor
        # a space may start or end an n-gram that has a letter
        inside = inside[: len(ahead)] & letter[k - 1 : n - 1] if k > 1 else inside[: len(ahead)]
        ok = letter if k == 0 else letter[:-1] | letter[1:] if k == 1 else inside
        if k + 1 in ORDERS:
            hashed.append(np.concatenate([(mixed ^ (mixed >> np.uint32(15))) * _FACTORS[0] >> shift, np.zeros(k, np.uint32)]))
            valid.append(np.concatenate([ok, np.zeros(k, bool)]))
    took = np.stack(valid, axis=1)
    buckets = np.stack(hashed, axis=1)[took].astype(np.int64)
    before = np.concatenate([[0], np.cumsum(took.sum(axis=1))])
    return buckets, before[starts], has_letter


def log_likelihood(buckets: np.ndarray, starts: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Texts x languages: the sparse rows times the log-probabilities."""
    out = np.zeros((len(starts), len(model.languages)))
    ends = np.append(starts[1:], len(buckets))
    filled = np.flatnonzero(ends > starts)
    if len(filled):
        for j in range(len(model.languages)):
            out[filled, j] = np.add.reduceat(model.log_probability[buckets, j], starts[filled], dtype=float)
    return out


def slices(texts: pa.Array):
    """(rows, parts) of bounded size over a column of texts; a long text comes in several parts."""
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts.to_pylist()):
        for part in cut(text or ""):
            if parts and held + len(part) > SLICE_CHARACTERS:
                yield np.array(rows), parts
                rows, parts, held = [], [], 0
            rows.append(row)
            parts.append(part)
            held += len(part) + 1
    if parts:
        yield np.array(rows), parts


def _counted(bits: int):
    def flush(held: dict):
        for language, (documents, counts) in held.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([language] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(counts[at], documents), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["language", "bucket", "n"])
        held.clear()

    def count(batches):
        held: dict[str, list] = {}
        for batch in batches:
            languages = batch["lang"].to_pylist()
            for rows, parts in slices(batch["text"]):
                buckets, starts, has_letter = ngrams(parts, bits)
                ends = np.append(starts[1:], len(buckets))
                groups: dict[str, list[int]] = {}
                for k, row in enumerate(rows):
                    groups.setdefault(languages[row], []).append(k)
                for language, some in groups.items():
                    if language not in held and len(held) == HELD_LANGUAGES:
                        yield from flush(held)
                    entry = held.setdefault(language, [0, np.zeros(1 << bits, np.int64)])
                    entry[0] += len(set(rows[[k for k in some if has_letter[k]]]))
                    entry[1] += np.bincount(np.concatenate([buckets[starts[k] : ends[k]] for k in some]), minlength=1 << bits)
        yield from flush(held)

    return count


def train(documents: DataFrame, learnable: Column, language_column: str = "lang", text_column: str = "text") -> LanguageModel:
    """Counts over the whole texts of all learnable rows with a language.

    Rows with a null text or language, or for which ``learnable`` is null, teach nothing; a text without letters only its
    language's name. Languages may be any strings; over 4,096 of them, the size bound of the model, are an error. A
    language's share of the texts with a letter is its prior.
    """
    taught = documents.where(learnable).select(F.col(language_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    taught = taught.where("lang IS NOT NULL AND text IS NOT NULL")
    most = MODEL_BYTES // 4
    names = sorted(r["lang"] for r in taught.select("lang").distinct().limit((most >> LEAST_BUCKET_BITS) + 1).collect())
    if len(names) > most >> LEAST_BUCKET_BITS:
        raise ValueError(f"more than {most >> LEAST_BUCKET_BITS:,} languages to learn")
    bits = min(BUCKET_BITS, (most // max(1, len(names))).bit_length() - 1)
    counted = taught.mapInArrow(_counted(bits), "language string, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    place = {name: k for k, name in enumerate(names)}
    counts, documents_of = np.zeros((1 << bits, len(names))), np.zeros(len(names))
    column = np.array([place[x] for x in found["language"].to_pylist()], np.int64)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    documents_of[column[bucket < 0]] = n[bucket < 0]
    counts[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    smooth = counts + SMOOTHING
    return LanguageModel(tuple(names), np.log((documents_of + 1) / (documents_of + 1).sum()), np.log(smooth / smooth.sum(axis=0)).astype(np.float32))


def _predicted(shared):
    def predict(batches):
        model: LanguageModel = shared.value
        for batch in batches:
            size = batch.num_rows
            sums, lettered = np.zeros((size, len(model.languages))), np.zeros(size, bool)
            for rows, parts in slices(batch["plumbline_text"]):
                buckets, starts, has_letter = ngrams(parts, model.bits)
                np.add.at(sums, rows, log_likelihood(buckets, starts, model))
                np.logical_or.at(lettered, rows, has_letter)
            names, scores = np.full(size, UNDETERMINED, object), np.zeros(size)
            if model.languages:
                sums += model.prior
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                names[lettered] = np.array(model.languages, object)[best[lettered]]
                scores[lettered] = share[lettered]
            kept = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "plumbline_text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names.tolist(), pa.string()), pa.array(scores)], names=["row", "lang_pred", "score"])

    return predict


def predict(documents: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """documents with lang_pred and score, the posterior probability of the predicted language.

    Null texts, texts without a letter, and all texts if nothing was learned get ``und`` and 0. Ties go to the language
    that sorts first. Every row gives one row and keeps its columns, but for columns named lang_pred or score, which are
    replaced. A text of any length is read whole, in parts that end after a space; only a run of more than 500,000
    characters without a space is cut inside.
    """
    kept = [c for c in documents.columns if c not in ("lang_pred", "score")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    packed = documents.select(row, F.col(f"`{text_column}`").alias("plumbline_text"))
    schema = packed.select("row").schema.add("lang_pred", "string").add("score", "double")
    done = packed.mapInArrow(_predicted(documents.sparkSession.sparkContext.broadcast(model)), schema)
    return done.select("row.*", "lang_pred", "score")
