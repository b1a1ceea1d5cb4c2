"""Documents as token ids in binary files, with Elias-Fano document boundaries.

A file holds the ids of its documents end to end, then the ends of the documents and
their ids as Elias-Fano lists, then a footer with the places of these parts. Any
document is found by two searches in the ends; no table of 64-bit offsets is needed.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm import tokens
from evalspark.llm.common import filesystem, in_chunks, stored
from evalspark.llm.elias_fano import EliasFano
from evalspark.session import qualified, scratch_path

MAGIC = b"EFTOKEN1"
MANIFEST = "shard int, part int, path string, n_docs long, n_ids long, n_bytes long"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, path string"


class TokenFileWriter:
    """Appends documents in rising order of their ids (null ids first)."""

    def __init__(self, path: str, dtype: str):
        files, place = filesystem(path)
        files.create_dir(place.rpartition("/")[0], recursive=True)
        self.path, self.dtype = path, dtype
        self.file = files.open_output_stream(place)
        self.file.write(MAGIC)
        self.ends: list[int] = []
        self.doc_ids: list[int] = []
        self.nulls = self.n_ids = 0
        self.width = np.dtype(dtype).itemsize

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.file.write(ids)
        self.n_ids += len(ids) // self.width
        self.ends.append(self.n_ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> int:
        """Write the lists and the footer; the bytes of the file."""
        least = self.doc_ids[0] if self.doc_ids else 0
        ends = EliasFano.of(np.array(self.ends, np.uint64)).to_bytes()
        # The gap between two longs may pass the largest long: subtract as unsigned.
        own = np.array(self.doc_ids, np.int64).view(np.uint64) - np.int64(least).view(np.uint64)
        doc_ids = EliasFano.of(own).to_bytes()
        at = len(MAGIC) + self.n_ids * self.width
        foot = json.dumps(
            {
                "dtype": self.dtype,
                "n_ids": self.n_ids,
                "ends": [at, len(ends)],
                "doc_ids": [at + len(ends), len(doc_ids)],
                "least": least,
                "nulls": self.nulls,
            }
        ).encode()
        self.file.write(ends + doc_ids + foot + len(foot).to_bytes(8, "little") + MAGIC)
        self.file.close()
        return at + len(ends) + len(doc_ids) + len(foot) + 8 + len(MAGIC)


class TokenFile:
    """Reads a token file: any document, or all of them in bounded blocks."""

    def __init__(self, path: str):
        files, place = filesystem(path)
        self.file = files.open_input_file(place)
        size = self.file.size()
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path}: not a whole token file")
        length = int.from_bytes(tail[:8], "little")
        foot = json.loads(self._read(size - 16 - length, length))
        self.dtype, self.n_ids = foot["dtype"], foot["n_ids"]
        self.width = np.dtype(self.dtype).itemsize
        self.ends = EliasFano.from_bytes(self._read(*foot["ends"]))
        self.doc_ids = EliasFano.from_bytes(self._read(*foot["doc_ids"]))
        self.least, self.nulls = foot["least"], foot["nulls"]

    def _read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def __len__(self) -> int:
        return len(self.ends)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def span(self, i: int) -> tuple[int, int]:
        """First id and end of document i, by searches in the Elias-Fano list."""
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.doc_ids[i - self.nulls] + self.least

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b of the file."""
        data = self._read(len(MAGIC) + a * self.width, (b - a) * self.width)
        return np.frombuffer(data, self.dtype)

    def document(self, i: int) -> np.ndarray:
        return self.ids(*self.span(i))

    def find(self, doc_id: int) -> int | None:
        """Place of a document by its id: a binary search over the list of ids."""
        a, b, want = 0, len(self.doc_ids), doc_id - self.least
        while a < b:
            mid = (a + b) // 2
            a, b = (mid + 1, b) if self.doc_ids[mid] < want else (a, mid)
        found = a < len(self.doc_ids) and self.doc_ids[a] == want
        return a + self.nulls if found else None

    def blocks(self, docs: int = 4096) -> Iterator[tuple[list, np.ndarray]]:
        """Document ids and bounds (one more than documents) of blocks of documents."""
        first = 0
        for a in range(0, len(self), docs):
            b = min(a + docs, len(self))
            bounds = np.concatenate(([first], self.ends.values(a, b).astype(np.int64)))
            known = self.doc_ids.values(max(0, a - self.nulls), max(0, b - self.nulls))
            signed = (known + np.int64(self.least).view(np.uint64)).view(np.int64)
            missing = max(0, min(b, self.nulls) - a)
            yield [None] * missing + signed.tolist(), bounds
            first = int(bounds[-1])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    most_ids: int = 1 << 27,
) -> DataFrame:
    """Encode whole texts, append the end id, write files in order of ``doc_id``.

    Documents are range-partitioned by id (equal ids by their text), sorted, and written
    by each task as it reads them; after ``most_ids`` ids a task starts another file.
    Returns the manifest, one row per file. A file's name has the number of the attempt
    that wrote it: after a retry or a second, speculative attempt, files that the
    manifest does not name are left-overs and never read. Null texts are encoded as
    empty, documents with a null id come first, repeated rows are written each. Without
    rows the manifest is empty. Other columns of ``docs`` are not read.
    """
    path = tokenizer or tokens.default_path()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, context = tokens.coder(path), TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        writer, rows = None, []

        def done():
            size = writer.close()
            rows.append((shard, len(rows), writer.path, len(writer.ends), writer.n_ids, size))

        for batch in in_chunks(batches, "text", tokens.CHUNK):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, coder.encode_all(batch.column("text"))):
                if writer is None:
                    name = f"{shard:06d}-{len(rows):04d}-{attempt}.eft"
                    writer = TokenFileWriter(f"{folder}/{name}", coder.dtype)
                writer.add(doc_id, ids.tobytes())
                if writer.n_ids >= most_ids:
                    done()
                    writer = None
        if writer is not None:
            done()
        names = ["shard", "part", "path", "n_docs", "n_ids", "n_bytes"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names
        )

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
    return stored(ordered.mapInArrow(task, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Each document of the files: place of its first id among all ids, count, CRC-32.

    The start of a file is the sum of the ids before it: a window over the manifest,
    which has one row per file. Files are read one to a task, in blocks.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with TokenFile(row["path"]) as file:
                    for doc_ids, bounds in file.blocks():
                        crcs = [
                            zlib.crc32(file.ids(a, b).astype("<u4"))
                            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(doc_ids, pa.int64()),
                                pa.array(bounds[:-1] + row["base"], pa.int64()),
                                pa.array(np.diff(bounds), pa.int64()),
                                pa.array(crcs, pa.int64()),
                                pa.array([row["path"]] * len(doc_ids), pa.string()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "path"],
                        )

    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = max(1, manifest.count())
    return based.repartition(files, "path").mapInArrow(task, SCHEMA)


def token_file_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all documents to token files in the shared scratch folder and read them."""
    folder = qualified(docs.sparkSession, scratch_path(docs.sparkSession, "token-files"))
    return read_token_files(write_token_files(docs, folder, tokenizer))
