"""Helpers shared by the text operators: tables, stored steps, files, lost executors."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.session import scratch_path

#: A word: characters between white space of ASCII, in Java's and Python's notation.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again.

    What follows starts from files that outlive an executor; Spark also knows their size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Columns that a job does not read travel in one struct, so no name of theirs can clash.
REST = "_rest"


def wrapped(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with its own columns as they are and all others in one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    # A struct needs a field, and this one a name that no column has.
    filler = "_" * (1 + max(map(len, docs.columns)))
    return docs.select(*own, F.struct(F.lit(0).alias(filler), *others).alias(REST))


def unwrapped(docs: DataFrame, *own: str, without: Iterable[str] = ()) -> list[Column]:
    """The columns of ``docs`` out of what ``wrapped`` made, in their order."""
    return [
        (F.col(c) if c in own else F.col(REST).getField(c)).alias(c) for c in docs.columns if c not in without
    ]


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for a plain path or any URI that Arrow knows."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def in_chunks(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most_bytes`` of a text column; a longer text comes alone."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_binary()).fill_null(b"")
        ends = sizes.offset + len(sizes)
        bounds = memoryview(sizes.buffers()[1]).cast("q")[sizes.offset : ends + 1]
        start = 0
        while start < len(sizes):
            stop = start + 1
            while stop < len(sizes) and bounds[stop + 1] - bounds[start] <= most_bytes:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column, empty for null."""
    return batch.column(column).cast(pa.large_binary()).fill_null(b"").to_pylist()


class Remembered(dict):
    """Values of a function by keys of bytes, of about ``most_bytes`` together.

    When the newer half is full it becomes the older half, whose values come back when
    they are asked for again; what is forgotten is made anew.
    """

    #: Bytes of an entry besides its key and value: their headers and the table's slot.
    ROOM = 160

    def __init__(self, make: Callable, most_bytes: int):
        super().__init__()
        self.make, self.half = make, most_bytes // 2
        self.size, self.older = 0, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if self.size > self.half:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self.size += self.ROOM + len(key) + (len(value) if isinstance(value, bytes) else 8)
        self[key] = value
        return value


def kept(key: tuple, make: Callable):
    """A value of this Python process, made once and kept from task to task.

    Modules of this package travel to the executors with the tasks and are made anew for
    each of them; this place is not. Only one value is kept: that of an earlier stage goes
    when the next one asks for its own.
    """
    store = sys.modules.setdefault("evalspark_kept", types.ModuleType("evalspark_kept")).__dict__
    values = store.setdefault("values", {})
    if key not in values:
        values.clear()
        values[key] = make()
    return values[key]
