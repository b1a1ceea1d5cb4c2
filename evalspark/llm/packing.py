"""Pack documents into training sequences of several lengths (hierarchical packing).

Whole windows of the longest length are cut off each document. What is left over goes to
the shortest tier that holds it; a left-over opens a window of its tier, and the gap is
filled from the shortest left-overs, the last of them cut to fit. Windows are thereby
full, and a full window's length is a power of two, so it needs no padding. What a block
of documents leaves over moves on to the next block; at the end of a task the rest is cut
into windows of powers of two. Sequences of a tier then form step groups of equal token
counts, dealt so that the cost of attention within documents is even.

Each task packs the documents it reads: no shuffle, and no key can be hot.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from evalspark.llm import tokens
from evalspark.llm.common import in_chunks

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("tier", pa.int32()),
        ("step_group", pa.int64()),
    ]
)
#: Each task numbers its sequences and step groups from here.
TASK_ROOM = 40


class Piece:
    """Ids ``start`` to ``start + length`` of a document."""

    __slots__ = ("doc_id", "ids", "start", "length")

    def __init__(self, doc_id, ids: np.ndarray, start: int, length: int):
        self.doc_id, self.ids, self.start, self.length = doc_id, ids, start, length

    def cut(self, length: int) -> Piece:
        """Take ``length`` ids off the front."""
        front = Piece(self.doc_id, self.ids, self.start, length)
        self.start += length
        self.length -= length
        return front


def tier_of(length: int, tiers: tuple[int, ...]) -> int:
    """The shortest tier that holds a piece; ``tiers`` fall."""
    return min(t for t in tiers if t >= length)


def fill(pieces: list[Piece], tiers: tuple[int, ...]):
    """Full windows as (tier, pieces), and the pieces left over.

    ``pieces`` are no longer than the longest tier. The longest open windows, the
    shortest fill the gaps; only the last piece of a window is cut.
    """
    queue = deque(sorted(pieces, key=lambda p: -p.length))
    full = []
    while queue:
        first = queue.popleft()
        tier = tier_of(first.length, tiers)
        window, room = [first], tier - first.length
        while room and queue:
            last = queue[-1]
            if last.length <= room:
                queue.pop()
            else:
                last = last.cut(room)
            window.append(last)
            room -= last.length
        if room:
            return full, window
        full.append((tier, window))
    return full, []


def close(pieces: list[Piece], window: int, least: int):
    """The last pieces of a task in windows of falling powers of two, the rest in one."""
    queue, out = deque(pieces), []
    left = sum(p.length for p in pieces)
    size = window
    while left:
        if left >= size or size <= least:
            room = min(size if left >= size else left, left)
            out.append((size if left >= size else window, took := []))
            left -= room
            while room:
                part = queue.popleft() if queue[0].length <= room else queue[0].cut(room)
                took.append(part)
                room -= part.length
        else:
            size //= 2
    return out


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number for each window: one tier and ``step_tokens`` ids to a group.

    Within a tier, windows go to its groups by falling cost (sum of squared piece
    lengths), forth and back, so that groups cost about the same.
    """
    groups, used = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own = [i for i, (t, _) in enumerate(windows) if t == tier]
        own.sort(key=lambda i: -sum(p.length**2 for p in windows[i][1]))
        count = -(-len(own) * tier // step_tokens)
        for place, i in enumerate(own):
            turn, at = divmod(place, count)
            groups[i] = used + (at if turn % 2 == 0 else count - 1 - at)
        used += count
    return groups


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    tiers: tuple[int, ...] = (2048, 1024, 512, 256),
    step_tokens: int = 1 << 16,
    block_ids: int = 1 << 21,
    least: int = 64,
) -> DataFrame:
    """One row per piece of a document, with its sequence and place there.

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names, are not
    read. A null or empty text is the end id alone. Repeated rows are packed each on its
    own. ``tiers`` are falling powers of two; a sequence shorter than the first is padded
    to it unless its length is a power of two, which leaves at most one padded sequence
    to a task. Without rows there are no pieces. ``block_ids`` bounds the ids held at a
    time (a longer document is a block of its own).
    """
    path = tokenizer or tokens.default_path()
    window = tiers[0]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(path)
        base = TaskContext.get().partitionId() << TASK_ROOM
        sequences = groups = 0
        rest: list[Piece] = []
        whole: list[tuple[int, list[Piece]]] = []
        held = 0

        def out(windows):
            nonlocal sequences, groups
            columns = [[] for _ in ARROW]
            numbers = step_groups(windows, step_tokens)
            for (tier, pieces), group in zip(windows, numbers):
                offset = 0
                for p in pieces:
                    crc = zlib.crc32(p.ids[p.start : p.start + p.length].astype("<u4"))
                    row = (p.doc_id, p.start, p.length, crc, len(p.ids), base + sequences)
                    for column, value in zip(columns, (*row, offset, tier, base + groups + group)):
                        column.append(value)
                    offset += p.length
                sequences += 1
            groups += max(numbers, default=-1) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW
            )

        for batch in in_chunks(batches, "text", tokens.CHUNK):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, coder.encode_all(batch.column("text"))):
                piece = Piece(doc_id, ids, 0, len(ids))
                while piece.length >= window:
                    whole.append((window, [piece.cut(window)]))
                if piece.length:
                    rest.append(piece)
                held += len(ids)
                if held >= block_ids:
                    full, rest = fill(rest, tiers)
                    yield out(whole + full)
                    whole, held = [], 0
        full, rest = fill(rest, tiers)
        yield out(whole + full + close(rest, window, least))

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return source.mapInArrow(task, SCHEMA)
