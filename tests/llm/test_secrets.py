"""Decoded layers: planted values under nested encodings, brute force for the base rules."""

import base64
import bz2
import gzip
import hashlib
import itertools
import lzma
import os
import re
import time
import urllib.parse
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evalspark.llm import secret_scan
from evalspark.llm.catalog import QUERIES
from evalspark.llm.common import table

SECRET = 'password = "hunter2hunter2'


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


CODES = {
    "url": lambda s: urllib.parse.quote(s, safe=""),
    "percent": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "u": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "brace": lambda s: "".join(f"\\u{{{ord(c):x}}}" for c in s),
    "wide": lambda s: "".join(f"\\U{ord(c):08x}" for c in s),
    "x": lambda s: "".join(f"\\x{b:02x}" for b in s.encode()),
    "entity": lambda s: "".join(f"&#{ord(c)};" for c in s),
    "hex entity": lambda s: "".join(f"&#x{ord(c):X};" for c in s),
    "full width": lambda s: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in s),
    "base64": b64,
    "url base64": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "gzip": lambda s: b64(gzip.compress(s.encode(), mtime=0)),
    "zlib": lambda s: b64(zlib.compress(s.encode())),
    "bz2": lambda s: b64(bz2.compress(s.encode())),
    "xz": lambda s: b64(lzma.compress(s.encode())),
    "percent gzip": lambda s: "".join(f"%{b:02X}" for b in gzip.compress(s.encode(), mtime=0)),
}


def found(text, **more):
    findings, _ = secret_scan.listed(text, **more)
    return [(kind, value, text[start:end]) for kind, start, end, _, value in findings]


@pytest.mark.parametrize("outer, inner", [*itertools.product(CODES, repeat=2)])
def test_values_under_two_encodings(outer, inner):
    hidden = CODES[outer](CODES[inner](f'{SECRET}"'))
    got = found(f"Prose é before, {hidden} and behind.")
    assert ("assign", SECRET) in {(kind, value) for kind, value, _ in got}
    assert all(place and place in hidden for _, _, place in got)


@pytest.mark.parametrize("name", ["zstd"])
def test_values_under_zstd(name):
    import zstandard

    hidden = b64(zstandard.ZstdCompressor().compress(SECRET.encode()))
    assert found(f"x {hidden}") == [("assign", SECRET, hidden.rstrip("="))] or found(f"x {hidden}")[0][1] == SECRET


def test_places_are_those_of_the_value():
    text = "é key: %41KIA0123456789ABCDEF and " + b64("id 0123456789abcdef01234567 x")
    got = secret_scan.listed(text)[0]
    assert [(f[0], text[f[1] : f[2]], f[3]) for f in got] == [
        ("access", "%41KIA0123456789ABCDEF", "escapes"),
        ("hex", b64("id 0123456789abcdef01234567 x")[4:36], "base64"),
    ]


def test_equal_values_are_found_at_each_place():
    hidden = b64(SECRET)
    assert len(found(f"a {hidden} b {hidden} c")) == 2


def test_base64_over_lines_and_behind_a_path():
    data = b64("words and words " * 20 + SECRET)
    for end in ("\n", "\r\n"):
        text = "key:\n" + end.join(data[i : i + 76] for i in range(0, len(data), 76)) + "\n"
        assert SECRET in {value for _, value, _ in found(text)}
    assert [v for _, v, _ in found(f"abcde/{b64(SECRET)}")] == [SECRET]


def test_many_nested_layers_take_linear_time():
    started = time.perf_counter()
    assert found("token=%" + "25" * 100_000 + "41bcdef")[0][:2] == ("assign", "token=Abcdef")
    deep = SECRET
    for _ in range(20):
        deep = b64(deep)
    assert [v for _, v, _ in found(deep)] == [SECRET]
    assert time.perf_counter() - started < 20


def test_bombs_are_counted_and_not_opened():
    text = "x " + b64(gzip.compress(b"a" * (8 << 20))) + " " + b64(SECRET)
    findings, unopened = secret_scan.listed(text, most_bytes=1 << 20)
    assert unopened == 1 and [f[4] for f in findings] == [SECRET]


def test_layers_that_hold_themselves_end(monkeypatch):
    same = b64(b"\x1f\x8bself")
    monkeypatch.setattr(secret_scan, "_inflated", lambda data, most: (b"\x1f\x8bself", 6))
    assert found(same) == []
    monkeypatch.setattr(secret_scan, "_inflated", lambda data, most: (f"in {same} out".encode(), 6))
    assert found(f"in {same} out") == []


@pytest.mark.parametrize(
    "text", ["", "100%de 50%", "\\u00", "&#;", "&#xZZ;", "%%%", "\\x4", "C:\\users\\x", "&#99999999999;", "x^2 BZh1"]
)
def test_broken_escapes_stay(text):
    assert found(text) == [] and found(f"{text}token=abcdef")[-1][1] == "token=abcdef"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="%\\ux0123456789abcdefAKI&#;{}=token_api \n１％", max_size=60))
def test_any_text_maps_back(text):
    plain, up = secret_scan.unescaped(text)
    at = 0
    for i in range(len(plain)):
        start, end = up(i, i + 1)
        assert start == at and end > start
        at = end
    assert at == len(text)


def base(text):
    """The fixed rules, one regular expression after the other."""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "API_KEY", "apikey", "passwd", "ſecret", "K", "=", " : ", '"', "abcdef", "0" * 23, "f", "AKIA", "A9" * 8, " ", "\n", "-", "é"])).map("".join))
def test_base_rules(text):
    assert [f[:3] for f in secret_scan.listed(text)[0] if not f[3]] == base(text)


def test_odd_rows(spark):
    rows = [(1, SECRET, "x"), (1, SECRET, "x"), (2, None, "x"), (3, "", "x"), (None, b64(SECRET), "x"), (5, "a" * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, findings string")
    got = {}
    for r in secret_scan.digests(secret_scan.secrets(docs)).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    none = hashlib.sha256(b"").hexdigest()
    one = f"assign:0:{len(SECRET)}"
    assert got[1] == [(1, 0, 0, hashlib.sha256(one.encode()).hexdigest(), one)] * 2
    assert got[2] == got[3] == [(0, 0, 0, none, "")]
    assert got[None][0][:4] == (0, 0, 0, none) and got[None][0][4].startswith("assign:0:")
    assert got[5][0][2] == 1
    assert secret_scan.secrets(docs.limit(0)).collect() == []


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF_DIR, "documents").collect()}
    got = QUERIES["op11_secret_layers"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for x, *_ in want) for k in secret_scan.KINDS]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
