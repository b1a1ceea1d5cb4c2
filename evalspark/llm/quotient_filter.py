"""Counting quotient filters over packed n-grams, without loss.

An n-gram of word ids is a number of as many lanes as words. A keyed permutation of such
numbers, which can be undone, spreads them evenly; its upper bits (the quotient) are the
place in the filter and all of its other bits (the remainder) are stored there, so the
filter holds n-grams and not their hashes. Filters are sorted by the permuted numbers: a
range of quotients is a part of the filter, and filters are merged like sorted lists.
"""

from __future__ import annotations

import struct

import numpy as np

ROUNDS = 3
_ODD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))
#: Rows, bytes of a row, bits of the part's name, bits of a quotient, part.
_HEADER = "<QBBBQ"
_WORD = 8


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[0]
    x = (x ^ (x >> np.uint64(27))) * _ODD[1]
    return x ^ (x >> np.uint64(31))


def lane_bits(top: int) -> int:
    """Bits of a lane for ids up to ``top``."""
    return max(1, top.bit_length())


def unused_bits(lanes: int, bits: int) -> int:
    """Zeros before the number in the first byte of a row."""
    return -lanes * bits % 8


def _turn(lanes: list[np.ndarray], bits: int, turn: int, i: int) -> None:
    mask = np.uint64((1 << bits) - 1)
    salt = np.uint64((turn * 8 + i + 1) * int(_ODD[2]) & (1 << 64) - 1)
    lanes[i] = lanes[i] ^ (_spread(lanes[(i + 1) % len(lanes)] + salt) & mask)


def permuted(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Two lanes or more after a Feistel network; the first depends on all of them."""
    lanes = list(lanes)
    for turn in range(ROUNDS):
        for i in reversed(range(len(lanes))):
            _turn(lanes, bits, turn, i)
    return lanes


def restored(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The way back of ``permuted``."""
    lanes = list(lanes)
    for turn in reversed(range(ROUNDS)):
        for i in range(len(lanes)):
            _turn(lanes, bits, turn, i)
    return lanes


def packed(lanes: list[np.ndarray], bits: int) -> np.ndarray:
    """Rows of big-endian bytes of the numbers that the lanes make up, the first one on top."""
    width = -(-len(lanes) * bits // 8)
    rows = np.zeros((len(lanes[0]), width), np.uint8)
    for byte in range(width):
        low = 8 * (width - 1 - byte)  # the byte's lowest bit in the number
        for i, lane in enumerate(lanes):
            shift = (len(lanes) - 1 - i) * bits - low  # of the lane against the byte
            if -bits < shift < 8:
                moved = lane << np.uint64(shift) if shift >= 0 else lane >> np.uint64(-shift)
                rows[:, byte] |= (moved & np.uint64(255)).astype(np.uint8)
    return rows


def unpacked(rows: np.ndarray, bits: int, lanes: int) -> list[np.ndarray]:
    width, mask = rows.shape[1], np.uint64((1 << bits) - 1)
    out = []
    for i in range(lanes):
        lane = np.zeros(len(rows), np.uint64)
        for byte in range(width):
            shift = 8 * (width - 1 - byte) - (lanes - 1 - i) * bits
            if -8 < shift < bits:
                own = rows[:, byte].astype(np.uint64)
                lane |= own << np.uint64(shift) if shift >= 0 else own >> np.uint64(-shift)
        out.append(lane & mask)
    return out


def _columns(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as few 64-bit numbers in the same order."""
    width = -(-rows.shape[1] // _WORD) * _WORD
    whole = np.zeros((len(rows), width), np.uint8)
    whole[:, : rows.shape[1]] = rows
    numbers = whole.view(">u8").astype(np.uint64)
    return [numbers[:, i] for i in range(numbers.shape[1])]


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row of each value in order, the order of all rows, and where values begin in it."""
    columns = _columns(rows)
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for column in columns:
        own = column[order]
        new[1:] |= own[1:] != own[:-1]
    starts = np.flatnonzero(new)
    return order[starts], order, starts


class QuotientFilter:
    """Counts of distinct rows of bytes, sorted.

    All rows share their first ``skip`` bits, which are ``part``: the filter is that part
    of a larger one.
    """

    def __init__(self, rows: np.ndarray, counts: np.ndarray, skip: int = 0, part: int = 0):
        self.rows, self.counts, self.skip, self.part = rows, counts.astype(np.uint64), skip, part

    def __len__(self) -> int:
        return len(self.rows)

    def _heads(self, size: int) -> np.ndarray:
        whole = np.zeros((len(self.rows), _WORD), np.uint8)
        whole[:, _WORD - size :] = self.rows[:, :size]
        return whole.view(">u8").reshape(-1).astype(np.uint64)

    def parts(self, skip: int) -> list[QuotientFilter]:
        """The filter cut at ranges of quotients that share their first ``skip`` bits."""
        size = -(-skip // 8)
        own = self._heads(size) >> np.uint64(8 * size - skip) if skip else np.zeros(len(self), np.uint64)
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(self) else []
        ends = [*starts[1:], len(self)] if len(self) else []
        return [
            QuotientFilter(self.rows[a:b], self.counts[a:b], skip, int(own[a])) for a, b in zip(starts, ends)
        ]

    def quotient_bits(self) -> int:
        """About as many quotients as rows, so that remainders are whole bytes."""
        wanted = max(1, len(self)).bit_length() + 1
        whole = -self.skip % 8
        return max(whole, whole + (wanted - whole) // 8 * 8)

    def to_bytes(self) -> bytes:
        """Header, occupied quotients, ends of runs, remainders, counts below 255, larger counts."""
        n, width = self.rows.shape
        bits = self.quotient_bits()
        size = (self.skip + bits) // 8
        quotients = self._heads(size) & np.uint64((1 << bits) - 1)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotients.astype(np.int64)] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotients[1:] != quotients[:-1]
        small = np.minimum(self.counts, np.uint64(255)).astype(np.uint8)
        large = self.counts[small == 255].astype("<u8")
        return b"".join(
            (
                struct.pack(_HEADER, n, width, self.skip, bits, self.part),
                np.packbits(occupied).tobytes(),
                np.packbits(ends).tobytes(),
                np.ascontiguousarray(self.rows[:, size:]).tobytes(),
                small.tobytes(),
                large.tobytes(),
            )
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        n, width, skip, bits, part = struct.unpack_from(_HEADER, data)
        at, size = struct.calcsize(_HEADER), (skip + bits) // 8

        def take(count: int) -> np.ndarray:
            nonlocal at
            at += count
            return np.frombuffer(data, np.uint8, count, at - count)

        places = 1 << bits
        occupied = np.flatnonzero(np.unpackbits(take(-(-places // 8)), count=places)).astype(np.uint64)
        ends = np.unpackbits(take(-(-n // 8)), count=n)
        run = np.cumsum(ends, dtype=np.int64) - ends
        heads = occupied[run] | np.uint64(part << bits)
        rows = np.empty((n, width), np.uint8)
        rows[:, :size] = heads.astype(">u8").view(np.uint8).reshape(-1, _WORD)[:, _WORD - size :]
        rows[:, size:] = take(n * (width - size)).reshape(n, width - size)
        counts = take(n).astype(np.uint64)
        large = counts == 255
        counts[large] = np.frombuffer(data, "<u8", int(large.sum()), at)
        return cls(rows, counts, skip, part)

    def count(self, row: np.ndarray) -> int:
        """The count of one row of bytes, 0 if it is not in the filter."""
        low, high, key = 0, len(self), row.tobytes()
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.rows[mid].tobytes() < key else (low, mid)
        return int(self.counts[low]) if low < len(self) and self.rows[low].tobytes() == key else 0

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> tuple[QuotientFilter, list[np.ndarray]]:
        """One filter with the sums, and the place in it of each row of each filter."""
        rows = np.concatenate([f.rows for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        first, order, starts = distinct(rows)
        sums = np.add.reduceat(counts[order], starts) if len(rows) else counts
        turn = np.zeros(len(rows), np.int64)
        turn[starts[1:]] = 1
        places = np.empty(len(rows), np.int64)
        places[order] = np.cumsum(turn)
        bounds = np.cumsum([len(f) for f in filters])[:-1]
        return cls(rows[first], sums, filters[0].skip, filters[0].part), np.split(places, bounds)


def counted(lanes: list[np.ndarray], bits: int) -> tuple[QuotientFilter, np.ndarray]:
    """A filter of n-grams given by their lanes, and the place in it of each of them."""
    raw = packed(lanes, bits)
    first, order, starts = distinct(raw)
    counts = np.diff(np.r_[starts, len(raw)])
    turn = np.zeros(len(raw), np.int64)
    turn[starts[1:]] = 1
    value = np.empty(len(raw), np.int64)
    value[order] = np.cumsum(turn)
    rows = packed(permuted([lane[first] for lane in lanes], bits), bits)
    by = _columns(rows)
    rank = np.lexsort(by[::-1])
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    return QuotientFilter(rows[rank], counts[rank]), place[value]
