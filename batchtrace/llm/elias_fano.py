"""Elias-Fano coding of a non-decreasing sequence of offsets.

Each value is cut into ``low_bits`` low bits, stored packed, and a high part,
stored in unary in one bit array (bit ``high + index`` is set). That is about
``2 + log2(u / n)`` bits a value. ``select`` finds the position of the i-th set
bit from a sampled directory and a scan of a few 64-bit words, so one offset is
read without decoding the others and without a table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

#: Every SAMPLE-th set bit has its position in the directory.
SAMPLE = 256
_HEAD = "<QQBII"  # values, largest value, low bits, words of high bits, samples


class EliasFano:
    def __init__(self, n: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.top, self.low_bits = n, top, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.ascontiguousarray(values, dtype=np.uint64)
        n = len(values)
        if n and np.any(values[1:] < values[:-1]):
            raise ValueError("the values must not decrease")
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(high[-1]) + 1) // 64) * 64 if n else 0, dtype=np.uint8)
        bits[high] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        return cls(n, top, low_bits, low, words, high[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack(_HEAD, self.n, self.top, self.low_bits, len(self.high), len(self.samples))
        return head + self.high.astype("<u8").tobytes() + self.samples.tobytes() + self.low.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, top, low_bits, words, sampled = struct.unpack_from(_HEAD, data)
        at = struct.calcsize(_HEAD)
        high = np.frombuffer(data, "<u8", words, at)
        samples = np.frombuffer(data, "<u4", sampled, at + 8 * words)
        low = np.frombuffer(data, np.uint8, -(-n * low_bits // 8), at + 8 * words + 4 * sampled)
        return cls(n, top, low_bits, low, high, samples)

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i[:, None] * self.low_bits + np.arange(self.low_bits)
        got = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return (got.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE + 1  # set bits to pass, the sampled one included
        k = at >> 6
        word = int(self.high[k]) >> (at & 63) << (at & 63)
        while (ones := word.bit_count()) < left:
            left -= ones
            k += 1
            word = int(self.high[k])
        for _ in range(left - 1):
            word &= word - 1
        position = (k << 6) + (word & -word).bit_length() - 1
        return ((position - i) << self.low_bits) + int(self._low(np.array([i]))[0])

    def select_range(self, start: int, stop: int) -> np.ndarray:
        """Values start..stop-1: one directory lookup, then a scan."""
        if start >= stop:
            return np.zeros(0, dtype=np.int64)
        base = start // SAMPLE * SAMPLE
        first = int(self.samples[start // SAMPLE]) >> 6
        last = int(self.samples[(stop - 1) // SAMPLE + 1]) >> 6 if (stop - 1) // SAMPLE + 1 < len(self.samples) \
            else len(self.high) - 1
        bits = np.unpackbits(self.high[first:last + 1].view(np.uint8), bitorder="little")
        ones = np.flatnonzero(bits) + (first << 6)
        ones = ones[ones >= int(self.samples[start // SAMPLE])][start - base:stop - base]
        i = np.arange(start, stop)
        return ((ones - i) << self.low_bits) + self._low(i)
