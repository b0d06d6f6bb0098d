"""Token-ID output: concatenated ids with Elias-Fano document boundaries, written in ascending document order and read back.

A file holds the documents of one range of identifiers, or a part of it. Its format, all integers little-endian:

    magic "PLIDS1" and two zero bytes; partition u4; file's number in the partition u4; documents without an identifier
    u8; ids of the partition before this file u8; ids u8; bytes per id u1 and seven zero bytes; the ids; the ends of the
    documents' ids (Elias-Fano); the identifiers (Elias-Fano)

Boundaries and identifiers ascend, so both take about two bits and a logarithm each, and ``select`` gives any one without
a table of 64-bit offsets. Files are named by partition and number, so a repeated task writes the same names again.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.lineage import ensure_checkpoint_dir
from plumbline.llm.eliasfano import EliasFano, encode

MAGIC = b"PLIDS1\0\0"
_HEAD = np.dtype([("magic", "S8"), ("partition", "<u4"), ("number", "<u4"), ("nameless", "<u8"), ("before", "<u8"), ("ids", "<u8"), ("width", "u1"), ("pad", "S7")])
FILE_IDS = 2 << 20
PARTITION_BYTES = 16 << 20
SLICE_BYTES = 8 << 20
#: Words whose ids a worker keeps, and the bytes of the longest.
CACHE = 400_000
CACHED_BYTES = 32
#: Words given to the library as one text, in bytes; the last one may pass it.
JOINED_BYTES = 256 << 10
#: White space as the tokenizer's pattern sees it, for RE2.
_SPACE = r"[\t\n\x0b\f\r \x{85}\p{Z}]"


class Encoder:
    """The ids of texts by a byte-level BPE file of the tokenizers library, each distinct space-separated piece once.

    Such a tokenizer never joins a space with what stands before it, so a text may be cut before any space that stands
    between two other characters than white space, and the pieces be encoded by themselves. Texts with other white space
    beside a space, or with a special token's string, are encoded whole. For the same reason words may be joined by spaces
    and given to the library many at a time: each id that starts with a space starts a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # Ġ is the printable stand-in that byte-level vocabularies use for a space
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.known, self.ids, self.lengths = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        # one at a time, since the library's result takes over 100 bytes an id
        ids = [np.array(e.ids, np.uint32) for t in texts for e in self.tokenizer.encode_batch_fast([t], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that each follow a space, and how many each has; they neither start nor end with white space."""
        ends = np.cumsum(pc.binary_length(words).to_numpy() + 1)
        cuts = np.append(np.flatnonzero(np.diff(ends // JOINED_BYTES, prepend=-1)), len(words))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words), pa.scalar(" ", pa.large_string()))
        ids, _ = self._each([f" {t}" for t in joined.to_pylist()])
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(words) or any(" " in token for token in self.special):
            return self._each([f" {w}" for w in words.to_pylist()])
        return ids, np.diff(starts, append=len(ids))

    def _following(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct words that each follow a space: ids and their numbers of known words, and which of those each word is."""
        at = pc.index_in(words, self.known)
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        added = words.take(pa.array(new))
        edged = pc.match_substring_regex(added, rf"^({_SPACE}|$)|{_SPACE}$").to_numpy(zero_copy_only=False)
        long = pc.binary_length(added).to_numpy() > CACHED_BYTES
        order = np.lexsort((long, edged))
        place[new[order]] = len(self.known) + np.arange(len(new))
        added, inner = added.take(pa.array(order)), int((~edged).sum())
        parts = [(self.ids, self.lengths), self._joined(added.slice(0, inner)), self._each([f" {w}" for w in added.slice(inner).to_pylist()])]
        ids, lengths = (np.concatenate(p) for p in zip(*parts, strict=True))
        if len(self.known) < CACHE:
            short = int((~edged & ~long).sum())
            self.known = pa.concat_arrays([self.known, added.slice(0, min(short, CACHE - len(self.known)))])
            self.lengths = lengths[: len(self.known)].copy()
            self.ids = ids[: int(self.lengths.sum())].copy()
        return ids, lengths, place

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, ``end_id`` after each text, and how many each text has."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, f" {_SPACE}|{_SPACE} ")
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        slow = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        # a text that is encoded whole counts as one piece
        split = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        codes = split.flatten().dictionary_encode()
        index, words = codes.indices.to_numpy().astype(np.int64), codes.dictionary
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        distinct, first = np.unique(index[offsets[:-1]], return_inverse=True)
        later = np.flatnonzero(np.bincount(index, minlength=len(words)) > np.bincount(index[offsets[:-1]], minlength=len(words)))
        place = np.zeros(len(words), np.int64)
        ids, lengths, place[later] = self._following(words.take(pa.array(later)))
        parts = [(ids, lengths), self._each(words.take(pa.array(distinct)).to_pylist()), self._each(texts.take(pa.array(slow)).to_pylist())]
        parts.append((np.array([end_id], np.uint32), np.ones(1, np.int64)))
        flat, sizes = (np.concatenate(p) for p in zip(*parts, strict=True))
        index = place[index]
        index[offsets[:-1]] = len(lengths) + first
        index[offsets[slow]] = len(lengths) + len(distinct) + np.arange(len(slow))
        index = np.insert(index, offsets[1:], len(sizes) - 1)
        starts = np.cumsum(sizes) - sizes
        took = sizes[index]
        sums = np.concatenate([[0], np.cumsum(took)])
        ids = flat[np.repeat(starts[index] - sums[:-1], took) + np.arange(int(sums[-1]))]
        return ids, np.diff(sums[offsets + np.arange(len(offsets))])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; the library uses one thread, as Spark gives a task one core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def file_bytes(partition: int, number: int, before: int, names: list[int | None], ids: np.ndarray, counts: np.ndarray) -> bytes:
    named = np.array([i for i in names if i is not None], np.int64)
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    head = np.zeros(1, _HEAD)
    head[0] = (MAGIC, partition, number, len(names) - len(named), before, len(ids), width, b"")
    return head.tobytes() + ids.astype(f"<u{width}").tobytes() + encode(np.cumsum(counts)) + encode(named)


class TokenFile:
    """A file's ids, document ends and identifiers; documents without an identifier come first."""

    def __init__(self, content: bytes):
        head = np.frombuffer(content, _HEAD, 1)[0]
        if head["magic"] != MAGIC.rstrip(b"\0"):
            raise ValueError("not a token file")
        self.partition, self.before, self.nameless = int(head["partition"]), int(head["before"]), int(head["nameless"])
        self.ids = np.frombuffer(content, f"<u{head['width']}", int(head["ids"]), _HEAD.itemsize)
        self.ends = EliasFano(content, _HEAD.itemsize + self.ids.nbytes)
        self.names = EliasFano(content, self.ends.end)

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the file."""
        return self.ids[self.ends.select(k - 1) if k else 0 : self.ends.select(k)]


def _slices(batches):
    """Identifiers and texts in parts of about as many bytes, with 8 for each row."""
    names, parts, held = [], [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy() + 8
        at = 0
        while at < len(sizes):
            end = at + max(int(not parts), int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_BYTES - held, side="right")))
            names += batch["doc_id"].slice(at, end - at).to_pylist()
            parts.append(batch["text"].slice(at, end - at))
            held += int(sizes[at:end].sum())
            if end < len(sizes):
                yield names, pa.concat_arrays(parts)
                names, parts, held = [], [], 0
            at = end
    if parts:
        yield names, pa.concat_arrays(parts)


def _write(folder: str, path: str, end_id: int):
    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        partition, number, before = TaskContext.get().partitionId(), 0, 0
        names, parts, counts, held = [], [], [], 0

        def flush():
            nonlocal number, before, names, parts, counts, held
            name = f"{base}/part-{partition:06d}-{number:06d}.ids"
            ids = np.concatenate(parts)
            attempt = f"{base}/.{TaskContext.get().taskAttemptId()}-{number}"
            with store.open_output_stream(attempt) as out:
                out.write(file_bytes(partition, number, before, names, ids, np.concatenate(counts)))
            store.move(attempt, name)
            number, before = number + 1, before + held
            names, parts, counts, held = [], [], [], 0

        for some, texts in _slices(batches):
            ids, lengths = encoder(path).encode(texts, end_id)
            names += some
            parts.append(ids)
            counts.append(lengths)
            held += len(ids)
            if held >= FILE_IDS:
                flush()
        if names:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([partition], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64())], names=["partition", "files", "ids"])

    return write


def write_token_files(documents: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> list[int]:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of the identifiers.

    folder is a URI that all executors reach. Returns the number of ids in each partition, in order; what is gathered is
    one number per partition. A null text is empty; rows without an identifier come first; rows that repeat an identifier
    are ordered by a hash of their text. Other columns are ignored.
    """
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # the ranges come from a sample that reaches the driver, so they are of numbers, not of texts
    order = ["doc_id", "turn"]
    dealt = rows.withColumn("turn", F.xxhash64("text")).repartitionByRange(max(1, math.ceil(total / PARTITION_BYTES)), *order).sortWithinPartitions(*order)
    done = dealt.select("doc_id", "text").mapInArrow(_write(folder, tokenizer_path, end_id), "partition int, files int, ids long").collect()
    return [r["ids"] for r in sorted(done, key=lambda r: r["partition"])]


def _read(starts: list[int]):
    def read(batches):
        for batch in batches:
            for content in batch["content"]:
                f = TokenFile(content.as_py())
                ends = f.ends.values()
                begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                raw = memoryview(f.ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                names = [*[None] * f.nameless, *f.names.values().tolist()]
                columns = [pa.array(names, pa.int64()), pa.array(begins + (starts[f.partition] + f.before), pa.int64()), pa.array(ends - begins, pa.int64()), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read_token_files(spark: SparkSession, folder: str, partition_ids: list[int]) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and the CRC-32 of each document's ids, from the files."""
    starts = np.concatenate([[0], np.cumsum(partition_ids)]).astype(int).tolist()
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not any(partition_ids):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").load(folder)
    return files.select("content").mapInArrow(_read(starts), schema)


def round_trip(documents: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write the token files into ``folder`` (a new one in the checkpoint folder if none is given) and read them back."""
    spark = documents.sparkSession
    if folder is None:
        folder = f"{ensure_checkpoint_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    if not re.match(r"\w+:", folder):
        folder = f"file://{folder}"
    return read_token_files(spark, folder, write_token_files(documents, folder, tokenizer_path, end_id, id_column, text_column))
