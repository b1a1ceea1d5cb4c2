"""Secrets in texts and in what is encoded inside them: a worklist of decoded layers.

A text is the first layer. Each layer is searched, and what it holds in encoded form
becomes layers of its own until nothing new comes up: escapes (percent signs, ``\\u``,
``\\x``, numeric entities, full-width letters) undone over the whole layer, runs of base64,
and compressed bytes (gzip, zlib, bzip2, xz, zstd) behind either. Every layer knows which
stretch of its parent a stretch of its own comes from, so matches are reported by their
places in the text.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import io
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import in_chunks

#: Kinds in the order in which matches at one place are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
LEAST_VALUE = 6
KEYWORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Runs that base64 or long hexadecimal numbers can be: 16 characters hold 12 bytes, as
#: many as the shortest match.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
LEAST_LINE = 32
LAST_LINE = re.compile(r"\r?\n([A-Za-z0-9+/_-]{1,15}={0,2})(?![A-Za-z0-9+/_-])")
URL_SAFE = str.maketrans("-_", "+/")
#: Bytes worth a layer: as many readable ones in a row, or full-width letters.
READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{12}|\xef[\xbc\xbd][\x80-\xbf]")
ESCAPED = re.compile(r"%[0-9A-Fa-f]{2}|\\[uUx]|&#|[！-～]")
SPECIAL = re.compile(r"[%\\&！-～]")
DIGITS = frozenset("0123456789abcdefABCDEF")
ENDS = DIGITS | {"}", ";"}
#: No escape is longer.
LONGEST = 12
#: Bytes of 128 and more from escapes, until their layer is done.
HIGH = 0xDC00
MAGIC = (b"\x1f\x8b", b"x\x01", b"x^", b"x\x9c", b"x\xda", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
PACKED = re.compile("\x1f\udc8b|x[\x01^\udc9c\udcda]|BZh|\udcfd7zXZ\x00|\\(\udcb5/\udcfd")
HIGH_BYTE = re.compile("[\udc80-\udcff]")
BYTES = re.compile("[\x00-\x7f\udc80-\udcff]+")
#: Bytes that the compressed layers of one text may have together.
MOST_BYTES = 64 << 20
FINDING = "array<struct<kind:string,start:bigint,end:bigint,layers:string,value:string>>"

Mapping = Callable[[int, int], tuple[int, int]]


class Layer:
    """A text, where it comes from, and how its places lie in its parent."""

    def __init__(self, text: str, parent: Layer | None = None, how: str = "", up: Mapping | None = None):
        self.text, self.parent, self.up = text, parent, up
        self.layers = f"{parent.layers}/{how}".lstrip("/") if parent else ""
        self.digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def origin(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.parent:
            start, end = layer.up(start, end)
            layer = layer.parent
        return start, end

    def repeats(self) -> bool:
        """Whether a layer above holds the same text."""
        layer = self.parent
        while layer and layer.digest != self.digest:
            layer = layer.parent
        return layer is not None


def matches(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the matches in one layer, leftmost first within a kind."""
    out = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    for run in RUN.finditer(text):
        if run.end() - run.start() >= 24:
            out += [("hex", *m.span()) for m in HEX.finditer(text, *run.span())]
    return out


def _escape(tail: list[tuple[str, int, int]], joined: bool) -> tuple[int, str] | None:
    """Length of the escape that the last character completes, and the character it stands for.

    With ``joined``, bytes of 128 and more that make up a character become that character.
    """
    last = tail[-1][0]
    if joined and "\udc80" <= last <= "\udcff":
        for size in range(2, min(4, len(tail)) + 1):
            codes = [ord(c) - HIGH for c, _, _ in tail[-size:]]
            if not all(128 <= code < 256 for code in codes):
                return None
            if codes[0] >= 0xC0:
                try:
                    return size, bytes(codes).decode()
                except UnicodeDecodeError:
                    return None
        return None
    if last not in ENDS and not "！" <= last <= "～":
        return None
    chars = [c for c, _, _ in tail[-LONGEST:]]
    n = len(chars)

    def number(start: int, stop: int | None, base: int) -> int | None:
        digits = "".join(chars[start:stop])
        allowed = DIGITS if base == 16 else "0123456789"
        return int(digits, base) if digits and all(c in allowed for c in digits) else None

    def point(code: int | None) -> str | None:
        if code is None or code > 0x10FFFF:
            return None
        return "�" if 0xD800 <= code < 0xE000 else chr(code)

    def byte(code: int | None) -> str | None:
        return None if code is None else chr(code if code < 128 else HIGH + code)

    if "！" <= last <= "～":
        return 1, chr(ord(last) - 0xFEE0)
    if last in DIGITS:
        forms = ((3, "%", byte), (4, "\\x", byte), (6, "\\u", point), (10, "\\U", point))
        for size, mark, rule in forms:
            if n >= size and "".join(chars[n - size : n - size + len(mark)]) == mark:
                char = rule(number(n - size + len(mark), None, 16))
                if char is not None:
                    return size, char
    if last in "};":
        mark = "\\u{" if last == "}" else "&#"
        at = "".join(chars).rfind(mark)
        if at >= 0:
            at += len(mark)
            is_hex = last == "}" or (at < n and chars[at] in "xX")
            char = point(number(at + (last == ";" and is_hex), n - 1, 16 if is_hex else 10))
            if char is not None:
                return n - at + len(mark), char
    return None


def unescaped(text: str, joined: bool = True) -> tuple[str, Mapping]:
    """The text with its escapes undone, also those that undoing makes, and its mapping.

    Bytes of 128 and more are joined to characters, or stay apart for compressed layers.

    Every character is pushed once; where it completes an escape, that is taken off and its
    character is pushed instead. So nested escapes of any depth take linear time.
    """
    out: list[str] = []
    places: list[int] = []  # in the result, where a piece begins
    origins: list[tuple[int, int]] = []  # start in the text, and end for a character by itself
    size = at = 0

    def piece(part: str, start: int, end: int) -> None:
        nonlocal size
        out.append(part)
        places.append(size)
        origins.append((start, end))
        size += len(part)

    while at < len(text):
        m = SPECIAL.search(text, at)
        stop = m.start() if m else len(text)
        if stop > at:
            piece(text[at:stop], at, -1)
            at = stop
        # From a special character on, one by one, until no escape can be open.
        tail: list[tuple[str, int, int]] = []
        open_ = 0
        while at < len(text) and (not tail or len(tail) - open_ < LONGEST):
            tail.append((text[at], at, at + 1))
            at += 1
            while found := _escape(tail, joined):
                n, char = found
                start, end = tail[-n][1], tail[-1][2]
                del tail[-n:]
                tail.append((char, start, end))
                open_ = min(open_, len(tail) - 1)
            if SPECIAL.match(tail[-1][0]):
                open_ = len(tail) - 1
        for char, start, end in tail:
            piece(char, start, end)

    def up(start: int, end: int) -> tuple[int, int]:
        def lies(place: int) -> tuple[int, int]:
            i = bisect_right(places, place) - 1
            first, last = origins[i]
            return (first, last) if last >= 0 else (first + place - places[i], first + place - places[i] + 1)

        if end <= start:
            return (lies(start)[0] if start < size else len(text),) * 2
        return lies(start)[0], lies(end - 1)[1]

    return "".join(out), up


class TooLarge(Exception):
    pass


def _inflated(data: bytes, most: int) -> tuple[bytes, int]:
    """What one compressed stream holds, as far as it can be read, and its own size."""
    out = io.BytesIO()
    used = len(data)
    try:
        if data.startswith(MAGIC[-1]):
            import zstandard

            source = io.BytesIO(data)
            reader = zstandard.ZstdDecompressor(max_window_size=1 << 27).stream_reader(source)
            while part := reader.read(1 << 16):
                out.write(part)
                if out.tell() > most:
                    raise TooLarge
            return out.getvalue(), used
        kinds = {b"BZh": bz2.BZ2Decompressor, b"\xfd7z": lambda: lzma.LZMADecompressor(memlimit=1 << 28)}
        make = kinds.get(data[:3])
        if make is None:
            stream = zlib.decompressobj(47)
            rest = data
            while rest and not stream.eof:
                part = stream.decompress(rest, 1 << 16)
                out.write(part)
                rest = stream.unconsumed_tail
                if out.tell() > most:
                    raise TooLarge
                if not part and not rest:
                    break
            return out.getvalue(), used - len(stream.unused_data)
        stream = make()
        rest = data
        while not stream.eof:
            part = stream.decompress(rest, 1 << 16)
            out.write(part)
            rest = b""
            if out.tell() > most:
                raise TooLarge
            if not part and stream.needs_input:
                break
        used -= len(stream.unused_data)
    except TooLarge:
        raise
    except Exception:  # damaged or no such stream: what came out so far counts
        pass
    return out.getvalue(), used


def _as_text(data: bytes) -> tuple[str, Callable[[int], int]]:
    """Text of bytes and the place in bytes of a place in it."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1"), lambda i: i
    return text, (lambda i: i) if text.isascii() else lambda i: len(text[:i].encode())


def _runs(text: str) -> Iterator[tuple[str, Callable[[int], int]]]:
    """Runs of base64 characters, also over lines of equal width, and their places.

    The last line of a block may be of any shorter length.
    """
    lines: list[tuple[int, str]] = []

    def block() -> Iterator[tuple[str, Callable[[int], int]]]:
        width, last = len(lines[0][1]), lines[-1]
        if width < LEAST_LINE or "=" in "".join(line for _, line in lines[:-1]):
            return
        if len(last[1]) == width and last[1][-1] != "=":
            end = LAST_LINE.match(text, last[0] + width)
            if end and len(end[1]) < width:
                lines.append((end.start(1), end[1]))
        if len(lines) > 1:
            starts = [start for start, _ in lines]
            yield "".join(line for _, line in lines), lambda i: (
                starts[k := min(i // width, len(starts) - 1)] + i - k * width
            )

    def follows(start: int, run: str) -> bool:
        width, last = len(lines[0][1]), lines[-1]
        between = text[last[0] + len(last[1]) : start]
        return len(last[1]) == width >= len(run) and between in ("\n", "\r\n")

    for m in RUN.finditer(text):
        start, run = m.start(), m[0]
        if lines and not follows(start, run):
            yield from block()
            lines = []
        lines.append((start, run))
        yield run, lambda i, start=start: start + i
    if lines:
        yield from block()


def _decoded(run: str) -> tuple[int, bytes] | None:
    """Bytes of a run of base64 and the characters before it, from the first start that makes sense."""
    plain = run.rstrip("=").translate(URL_SAFE)
    for skip in range(4):
        part = plain[skip:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        if data.startswith(MAGIC) or READABLE.search(data):
            return skip, data
    return None


class Scan:
    """The worklist over one text."""

    def __init__(self, text: str, most_bytes: int = MOST_BYTES):
        self.left = most_bytes
        self.unopened = 0
        self.findings: set[tuple[str, int, int, str, str]] = set()
        self.seen: set[tuple[bytes, int, int]] = set()
        self.work: list[Layer] = []
        self.add(Layer(text))
        while self.work:
            layer = self.work.pop()
            for kind, start, end in matches(layer.text):
                self.findings.add((kind, *layer.origin(start, end), layer.layers, layer.text[start:end]))
            self.unwrap(layer)

    def add(self, layer: Layer) -> None:
        key = (layer.digest, *layer.origin(0, len(layer.text)))
        if key not in self.seen and not layer.repeats():
            self.seen.add(key)
            self.work.append(layer)

    def unwrap(self, layer: Layer) -> None:
        text = layer.text
        for run, place in _runs(text):
            found = _decoded(run)
            if found:
                skip, data = found
                self.add_bytes(
                    layer, data, "base64", lambda i, j, skip=skip, place=place: (
                        place(skip + i * 8 // 6), place(skip + -(-j * 8 // 6) - 1) + 1
                    ),
                )
        if ESCAPED.search(text):
            plain, up = unescaped(text, joined=False)
            if HIGH_BYTE.search(plain):
                for m in PACKED.finditer(plain):
                    run = BYTES.match(plain, m.start())
                    data = bytes(ord(c) & 0xFF for c in run[0])
                    self.add_bytes(layer, data, "escapes", lambda i, j, up=up, at=m.start(): up(at + i, at + j))
                plain, up = unescaped(text)
            if plain != text:
                self.add(Layer(plain, layer, "escapes", up))

    def add_bytes(self, layer: Layer, data: bytes, how: str, up: Mapping) -> None:
        """A layer of decoded bytes, or of what they hold in compressed form."""
        known: set[bytes] = set()
        whole = None
        while data.startswith(MAGIC):
            digest = hashlib.blake2b(data).digest()
            try:
                inner, used = (b"", 0) if digest in known else _inflated(data, self.left)
            except TooLarge:
                self.unopened += 1
                return
            if not inner:
                break
            known.add(digest)
            whole = whole or up(0, used)
            self.left -= len(inner)
            data, how = inner, f"{how}/compressed"
        text, in_bytes = _as_text(data)
        if known:
            self.add(Layer(text, layer, how, lambda i, j: whole))
        else:
            self.add(Layer(text, layer, how, lambda i, j: up(in_bytes(i), in_bytes(j))))


def listed(text: str, most_bytes: int = MOST_BYTES) -> tuple[list[tuple], int]:
    """Findings by start, kind as listed and end, and the number of layers left unopened."""
    scan = Scan(text, most_bytes)
    order = sorted(scan.findings, key=lambda f: (f[1], KINDS.index(f[0]), f[2], f[3], f[4]))
    return order, scan.unopened


def secrets(docs: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``doc_id, findings, unopened``: secrets of each whole text, with their layers.

    A finding has its kind, start and end in the text (code points, end exclusive), the
    ``layers`` it was found under (empty for the text itself) and the value as decoded there.
    Places under base64 are those of the characters that hold the value; under compressed
    bytes they are the whole run. A secret that several layers show is a finding for each.
    Findings are sorted by start, kind as listed, and end.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Null and empty texts
    have no findings; repeated rows are searched each; without rows there is no result. A
    layer equal to one above it (a file that holds itself) is not opened again. Compressed
    layers of one text hold at most ``most_bytes`` together, so that a decompression bomb
    cannot take a task's memory; ``unopened`` counts layers beyond it.
    """
    names = ("kind", "start", "end", "layers", "value")
    struct = pa.struct([(n, pa.int64() if n in ("start", "end") else pa.string()) for n in names])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            found = [listed(t or "", most_bytes) for t in batch.column("text").to_pylist()]
            rows = [[dict(zip(names, f)) for f in findings] for findings, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(rows, pa.list_(struct)),
                    pa.array([n for _, n in found], pa.int64()),
                ],
                names=["doc_id", "findings", "unopened"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(task, f"doc_id long, findings {FINDING}, unopened long")


def digests(found: DataFrame) -> DataFrame:
    """Counts per kind and a digest of what the texts themselves show, and all spans."""

    def spans(findings: Column) -> Column:
        parts = F.transform(
            findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
        )
        return F.array_join(F.array_distinct(parts), ",")

    base = F.filter("findings", lambda f: f["layers"] == "")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(spans(base), 256).alias("base_sha256"), spans(F.col("findings")).alias("spans")
    )
