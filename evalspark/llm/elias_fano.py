"""Elias-Fano lists: rising numbers in about 2 + log2(largest / count) bits each."""

from __future__ import annotations

import struct

import numpy as np

#: The place of every so many-th one in the high bits is kept, to start a search from.
SAMPLE = 256
_HEAD = "<QQBQQQ"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class EliasFano:
    """A list of non-falling, non-negative numbers with access to any one of them.

    The low bits of each number are packed side by side. The high parts are written in
    unary: number ``i`` with high part ``h`` sets bit ``h + i``. ``select`` finds the
    i-th one from a sampled place and the bit counts of the bytes behind it.
    """

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.samples = count, low_bits, low, samples
        self.high = np.frombuffer(high, np.uint8)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        count = len(values)
        if not count:
            return cls(0, 0, b"", b"", np.zeros(0, "<u8"))
        if (values[1:] < values[:-1]).any():
            raise ValueError("numbers fall")
        low_bits = max(0, (int(values[-1]) // count).bit_length() - 1)
        low = values & np.uint64((1 << low_bits) - 1)
        bits = (low[:, None] >> np.arange(low_bits, dtype=np.uint64)).astype(np.uint8) & 1
        places = (values >> np.uint64(low_bits)) + np.arange(count, dtype=np.uint64)
        flags = np.zeros(int(places[-1]) + 1, np.uint8)
        flags[places.astype(np.int64)] = 1
        return cls(
            count,
            low_bits,
            np.packbits(bits.ravel(), bitorder="little").tobytes(),
            np.packbits(flags, bitorder="little").tobytes(),
            places[::SAMPLE].astype("<u8"),
        )

    def to_bytes(self) -> bytes:
        high, samples = self.high.tobytes(), self.samples.astype("<u8").tobytes()
        sizes = len(self.low), len(high), SAMPLE
        head = struct.pack(_HEAD, self.count, len(self.samples), self.low_bits, *sizes)
        return head + self.low + high + samples

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, samples, low_bits, low, high, step = struct.unpack_from(_HEAD, data)
        if step != SAMPLE:
            raise ValueError("another sampling step")
        a = struct.calcsize(_HEAD)
        b, c = a + low, a + low + high
        return cls(
            count, low_bits, data[a:b], data[b:c], np.frombuffer(data, "<u8", samples, c)
        )

    def __len__(self) -> int:
        return self.count

    def select(self, i: int) -> int:
        """Place of the i-th one (from 0) in the high bits."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        left += int(_ONES[self.high[byte] & ((1 << place % 8) - 1)])
        while True:
            counts = np.cumsum(_ONES[self.high[byte : byte + SAMPLE]], dtype=np.int64)
            at = int(np.searchsorted(counts, left, side="right"))
            if at < len(counts):
                left -= int(counts[at - 1]) if at else 0
                value = int(self.high[byte + at])
                ones = [b for b in range(8) if value >> b & 1]
                return (byte + at) * 8 + ones[left]
            left -= int(counts[-1])
            byte += SAMPLE

    def _low(self, a: int, b: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(b - a, np.uint64)
        first, last = a * self.low_bits, b * self.low_bits
        some = np.frombuffer(self.low, np.uint8)[first // 8 : -(-last // 8)]
        bits = np.unpackbits(some, bitorder="little")[first % 8 :][: last - first]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return bits.reshape(b - a, self.low_bits).astype(np.uint64) @ weights

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return (self.select(i) - i) << self.low_bits | int(self._low(i, i + 1)[0])

    def values(self, a: int = 0, b: int | None = None) -> np.ndarray:
        """Numbers a to b: two searches, then one pass over the bits between."""
        b = self.count if b is None else min(b, self.count)
        if a >= b:
            return np.zeros(0, np.uint64)
        first, last = self.select(a), self.select(b - 1)
        some = np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little")
        places = np.flatnonzero(some).astype(np.uint64) + np.uint64(first // 8 * 8)
        places = places[(places >= first) & (places <= last)]
        high = places - np.arange(a, b, dtype=np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(a, b)
