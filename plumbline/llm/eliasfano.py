"""Elias-Fano encoding of ascending integers, with samples for select, as numpy bit arrays."""

from __future__ import annotations

import math

import numpy as np

SAMPLE = 256
_HEAD = np.dtype([("n", "<u8"), ("base", "<i8"), ("low_bits", "<u1"), ("low_bytes", "<u8"), ("high_bytes", "<u8")])


def encode(values: np.ndarray) -> bytes:
    """Ascending 64-bit integers as: head, low bits, high parts in unary, and every SAMPLE-th one's place in those."""
    values = np.asarray(values, np.int64)
    n = len(values)
    base = int(values[0]) if n else 0
    rest = values.view(np.uint64) - np.uint64(base % (1 << 64))
    spread = int(rest[-1]) if n else 0
    low_bits = max(0, int(math.floor(math.log2(spread / n)))) if n and spread > n else 0
    low = rest & np.uint64((1 << low_bits) - 1)
    shifts = np.arange(low_bits, dtype=np.uint64)
    low_part = np.packbits(((low[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
    places = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    bits[places] = 1
    high_part = np.packbits(bits, bitorder="little").tobytes()
    head = np.array([(n, base, low_bits, len(low_part), len(high_part))], _HEAD).tobytes()
    return head + low_part + high_part + places[::SAMPLE].astype("<u4").tobytes()


class EliasFano:
    """Reads encoded integers from a buffer, one by ``select`` or all by ``values``."""

    def __init__(self, buffer: bytes | memoryview, at: int = 0):
        head = np.frombuffer(buffer, _HEAD, 1, at)[0]
        self.n, self.base, self.low_bits = int(head["n"]), int(head["base"]), int(head["low_bits"])
        at += _HEAD.itemsize
        self._low = np.frombuffer(buffer, np.uint8, int(head["low_bytes"]), at)
        at += len(self._low)
        self._high = np.frombuffer(buffer, np.uint8, int(head["high_bytes"]), at)
        at += len(self._high)
        self._samples = np.frombuffer(buffer, "<u4", -(-self.n // SAMPLE), at)
        self.end = at + self._samples.nbytes

    def select(self, i: int) -> int:
        """The i-th integer, from the sample before it and the bits up to it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self._samples[i // SAMPLE])
        left, byte = i % SAMPLE, start // 8
        bits = np.unpackbits(self._high[byte : byte + 1], bitorder="little")
        ones = np.flatnonzero(bits[start % 8 :]) + start
        while len(ones) <= left:  # further bytes, as many as may hold what is left
            left -= len(ones)
            byte, more = byte + 1, max(32, left // 4)
            ones = np.flatnonzero(np.unpackbits(self._high[byte : byte + more], bitorder="little")) + 8 * byte
            byte += more - 1
        low = np.unpackbits(self._low[i * self.low_bits // 8 : -(-(i + 1) * self.low_bits // 8)], bitorder="little")
        skip = i * self.low_bits % 8
        tail = sum(int(b) << k for k, b in enumerate(low[skip : skip + self.low_bits]))
        return self.base + ((int(ones[left]) - i) << self.low_bits) + tail

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        low = np.unpackbits(self._low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        low = (low.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high + low + np.uint64(self.base % (1 << 64))).view(np.int64)
