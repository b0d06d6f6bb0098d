"""Packed 64-bit hashes that chunks of documents exchange with ranges of the hash space.

Corpus-wide questions about hashes ("does this window start in a smaller document?", "does this shingle occur in another
document?") need every hash to meet its equals. A row per hash would cost about 20 bytes in a shuffle. Here a *chunk* of
documents sorts its distinct hashes and sends one row per (chunk, bucket), a *cell*, to the *bucket* that owns a range
of hashes; the bucket answers with one bit per entry, and the chunk, which sorts the same hashes again, reads the bits by
position. Repeats inside a chunk are merged before anything is shuffled, so a hash that a third of all documents hold
reaches its bucket once per chunk. Chunks and buckets are counted from the size of the input and stay bounded.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 6 << 20

CELL_SCHEMA = "bucket int, chunk int, hashes binary, extra binary"
FLAG_SCHEMA = "chunk int, bucket int, flags binary"


def sizes(documents: DataFrame, text: str = "text") -> tuple[int, int]:
    """Chunks and buckets for this many bytes of text, at least one each."""
    total = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, math.ceil(total / CHUNK_BYTES)), max(1, math.ceil(total / BUCKET_BYTES))


def chunk_of(chunks: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(chunks)).cast("int").alias("chunk")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash (SipHash) of every word."""
    if not words:
        return np.zeros(0, np.uint64)
    column = np.empty(len(words), object)
    column[:] = words
    return pd.util.hash_array(column, categorize=False)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of every ``width`` consecutive word hashes, by prefix sums."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    powers = np.full(n, BASE, np.uint64)
    powers[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(powers), out=sums[1:])
    back = np.full(n - width + 1, _INVERSE, np.uint64)
    back[0] = 1
    out = (sums[width:] - sums[:-width]) * np.cumprod(back)
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _planes(values: np.ndarray) -> bytes:
    """64-bit values as eight byte planes, compressed; planes of zeros cost nothing."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def _from_planes(blob: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view(np.uint64).ravel()


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit integers as bytes: their number, the least or first of them, and the differences to it."""
    values = values.view(np.uint64)
    n = len(values)
    if not n:
        return np.zeros(2, np.uint64).tobytes()
    first = values[0] if ascending else np.uint64(values.view(np.int64).min().view(np.uint64))
    rest = np.diff(values, prepend=first) if ascending else values - first
    return np.array([n, first], np.uint64).tobytes() + _planes(rest)


def unpack(blob: bytes, ascending: bool = False) -> np.ndarray:
    n, first = np.frombuffer(blob[:16], np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    rest = _from_planes(blob[16:], int(n))
    if ascending:
        rest[0] = first
        return np.cumsum(rest, dtype=np.uint64)
    return rest + first


def cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the bucket of each number starts in ascending hashes; the last entry is their length."""
    starts = np.array([(k << 64) // buckets for k in range(buckets)], np.uint64)
    return np.append(np.searchsorted(hashes, starts), len(hashes))


def cells(chunk: int, hashes: np.ndarray, extra: np.ndarray | None, buckets: int) -> pa.Table:
    """A row for every bucket that ascending distinct hashes touch; extra: a 64-bit integer for each."""
    at = cuts(hashes, buckets)
    full = np.flatnonzero(np.diff(at))
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array(np.full(len(full), chunk), pa.int32()),
            "hashes": pa.array([pack(hashes[at[k] : at[k + 1]], ascending=True) for k in full], pa.binary()),
            "extra": pa.array([None if extra is None else pack(extra[at[k] : at[k + 1]]) for k in full], pa.binary()),
        }
    )


def gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The hashes and extras of all cells of a bucket, and how many entries each cell has."""
    hashes = [unpack(b, ascending=True) for b in table["hashes"].to_pylist()]
    extra = [unpack(b) for b in table["extra"].to_pylist() if b is not None]
    return np.concatenate(hashes), np.concatenate(extra) if extra else np.zeros(0, np.uint64), [len(h) for h in hashes]


def flagged(table: pa.Table, flags: np.ndarray, lengths: list[int]) -> pa.Table:
    """One row of bits for every cell that has a set bit."""
    parts = np.split(flags, np.cumsum(lengths)[:-1])
    keep = [i for i, p in enumerate(parts) if p.any()]
    return pa.table(
        {
            "chunk": table["chunk"].take(pa.array(keep, pa.int64())).cast(pa.int32()),
            "bucket": table["bucket"].take(pa.array(keep, pa.int64())).cast(pa.int32()),
            "flags": pa.array([pa.compress(np.packbits(parts[i]).tobytes(), codec="zstd", asbytes=True) for i in keep], pa.binary()),
        }
    )


def flags_of(table: pa.Table, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that buckets sent back, in the order of the chunk's ascending distinct hashes."""
    out = np.zeros(len(hashes), bool)
    at = cuts(hashes, buckets)
    for k, blob in zip(table["bucket"].to_pylist(), table["flags"].to_pylist(), strict=True):
        n = int(at[k + 1] - at[k])
        raw = pa.decompress(blob, decompressed_size=(n + 7) // 8, codec="zstd", asbytes=True)
        out[at[k] : at[k + 1]] = np.unpackbits(np.frombuffer(raw, np.uint8), count=n)
    return out
