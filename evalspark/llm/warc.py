"""Deterministic sharded WARC archives: write pages, read them back.

Records are range-sorted by page id, so the same pages give the same files under the same
session settings. Tasks write files under temporary names and roll them by compressed
size; a second job moves the files that the manifest names to their final names and only
then stores the final manifest. Files that no manifest names were left by lost attempts.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import filesystem, in_chunks, stored
from evalspark.session import qualified, scratch_path

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, part int, path string, name string, records long, n_bytes long"
KINDS = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
NAMES = ["shard", "part", "path", "name", "records", "n_bytes"]
RESULT = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{payload_digest}')}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """One record; headers and digests come from the page alone.

    A response holds the HTTP head and the payload; a revisit the head alone, whose
    content length is that of the full payload.
    """
    own = digest(payload)
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    # Control characters would end the header line.
    target = "".join(c if " " < c != "\x7f" else "%%%02X" % ord(c) for c in url or "")
    lines = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, own),
        "WARC-Date": date,
        "WARC-Target-URI": target or "about:blank",
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{own}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Length": len(block),
    }
    if page_id is not None:
        lines["X-Page-ID"] = page_id
    if revisit:
        lines["WARC-Profile"] = PROFILE
        lines["WARC-Refers-To"] = record_id(refers_to, own)
        lines["X-Refers-To-Page-ID"] = refers_to
    text = "".join(f"{k}: {v}\r\n" for k, v in lines.items())
    return VERSION + text.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an unpacked archive."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(length := int(headers["content-length"]))
        if len(block) < length:
            raise ValueError("the last record is cut off")
        yield headers, block


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, digest, refers_to`` of pages whose payload a page with a larger id has.

    Digests alone are compared, so a payload that a third of the pages share costs a
    narrow join, which Spark can split, and no list.
    """
    payload = F.coalesce("html", F.lit(""))
    narrow = stored(
        pages.where(F.octet_length(payload) >= least_bytes).select(
            "page_id", F.unhex(F.sha1(payload)).alias("digest")
        ),
        "warc-digests",
    )
    first = stored(
        narrow.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 and refers_to is not null")
        .drop("n"),
        "warc-first",
    )
    found = narrow.join(first, "digest").where("page_id is null or page_id < refers_to")
    return found.select("page_id", "digest", "refers_to").distinct()


def write_archives(
    pages: DataFrame,
    folder: str,
    roll_bytes: int = 1 << 30,
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    level: int = 6,
) -> DataFrame:
    """Write each page as a record; the manifest, one row per archive.

    ``pages`` needs ``page_id, url, html``; other columns are not read. Of pages with
    equal payloads of at least ``least_bytes`` bytes the one with the largest id is a
    response, the others revisit it; repeated rows of that id are responses each. A null
    payload is empty, a null id is smaller than any and has no id header, a null url is
    ``about:blank``. Without rows there is no archive.

    Who revisits whom is put among the pages as narrow rows before the range sort, so
    payloads are shuffled once. An archive is closed once ``roll_bytes`` are written.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    payload = F.coalesce("html", F.lit(""))
    none = F.lit(None)
    bodies = pages.select(
        "page_id",
        F.unhex(F.sha1(payload)).alias("digest"),
        F.lit(1).alias("kind"),
        "url",
        payload.alias("html"),
        none.cast("long").alias("refers_to"),
    )
    marks = revisits(pages, least_bytes).select(
        "page_id", "digest", F.lit(0).alias("kind"), none.cast("string").alias("url"),
        none.cast("string").alias("html"), "refers_to",
    )
    # Where the payload is the same, so is the digest; a mark stands before its pages.
    ordered = (
        bodies.unionByName(marks)
        .repartitionByRange("page_id", "digest")
        .sortWithinPartitions("page_id", "digest", "kind", "url")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        files, place = filesystem(folder)
        files.create_dir(f"{place}/_temporary", recursive=True)
        rows, out, mark = [], None, None

        def close():
            nonlocal out
            out.close()
            out = None

        for batch in in_chunks(batches, "html"):
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    mark = row
                    continue
                same = mark and (mark["page_id"], mark["digest"]) == (row["page_id"], row["digest"])
                if out is None:
                    name = f"pages-{shard:06d}-{len(rows):04d}.warc.gz"
                    path = f"_temporary/{attempt}-{name}"
                    out = files.open_output_stream(f"{place}/{path}", compression=None)
                    rows.append([shard, len(rows), path, name, 0, 0])
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                refers = mark["refers_to"] if same else None
                data = record(row["page_id"], row["url"], row["html"].encode(), refers, date)
                data = member.compress(data) + member.flush()
                out.write(data)
                rows[-1][4] += 1
                rows[-1][5] += len(data)
                if rows[-1][5] >= roll_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(KINDS)], names=NAMES
        )

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{place}/{row['path']}", f"{place}/{row['name']}"
                try:
                    files.move(source, target)
                except OSError:  # an earlier attempt of this task has moved it
                    if files.get_file_info(target).type != pafs.FileType.File:
                        raise
            moved = batch.column("name")
            yield batch.set_column(2, "path", pa.array([f"{folder}/{n}" for n in moved.to_pylist()], pa.string()))

    written = stored(ordered.mapInArrow(write, MANIFEST), "warc-written")
    return stored(written.mapInArrow(commit, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives, payload digests and lengths checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, place = filesystem(path)
                rows = []
                with files.open_input_file(place) as raw, gzip.open(raw) as stream:
                    for headers, block in parse(stream):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        length = int(head.rpartition(b"Content-Length:")[2])
                        own = headers["warc-payload-digest"].removeprefix("sha1:")
                        kind = headers["warc-type"]
                        if kind == "response" and (digest(payload), len(payload)) != (own, length):
                            raise ValueError(f"{path}: a payload was changed")
                        ids = [headers.get(n) for n in ("x-page-id", "x-refers-to-page-id")]
                        page_id, refers = (int(i) if i is not None else None for i in ids)
                        rows.append((page_id, length, own, kind, refers))
                        if len(rows) == 10_000:
                            yield records(rows)
                            rows = []
                yield records(rows)

    def records(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names
        )

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files, "path").mapInArrow(read, RESULT)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write all pages below the shared scratch folder and read the archives."""
    folder = qualified(pages.sparkSession, scratch_path(pages.sparkSession, "warc"))
    return read_archives(write_archives(pages, folder, **options))
