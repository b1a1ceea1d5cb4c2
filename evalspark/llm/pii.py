"""Format-preserving pseudonyms for personal data: keyed Feistel permutations.

A value that passes its check (Luhn digit, octets, calendar, mod 97, ...) becomes a number
in the domain of its format, the number is permuted by a keyed Feistel network inside that
domain, and is written back in the same format. Equal values get equal pseudonyms in every
document, as nothing but the key, the format and the value decides; without the key the
way back is unknown.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.llm.common import in_chunks, unwrapped, wrapped

ROUNDS = 10
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
#: Characters of one kind change places with each other only.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
)


def permuted(value: int, domain: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of ``range(domain)``.

    A balanced Feistel network permutes the next even number of bits; its walk goes on
    until it is back inside the domain, which takes four steps or fewer on average.
    """
    half = max(1, -(-(domain - 1).bit_length() // 2))
    size, mask = -(-half // 8), (1 << half) - 1
    seed = tweak.encode() + domain.to_bytes(-(-domain.bit_length() // 8), "big")
    while True:
        left, right = value >> half, value & mask
        for turn in range(ROUNDS):
            data = seed + bytes([turn]) + right.to_bytes(size, "big")
            mixed, block = b"", 0
            while len(mixed) < size:
                mixed += hashlib.blake2b(data + bytes([block]), key=key).digest()
                block += 1
            left, right = right, left ^ (int.from_bytes(mixed[:size], "big") & mask)
        value = left << half | right
        if value < domain:
            return value


def permuted_digits(digits: str, key: bytes, tweak: str) -> str:
    if not digits:
        return digits
    return str(permuted(int(digits), 10 ** len(digits), key, tweak)).zfill(len(digits))


def permuted_text(text: str, key: bytes, tweak: str, alphabets=ALPHABETS) -> str:
    """Each character becomes one of its own alphabet; others stay where they are."""
    kinds = [next((a for a in alphabets if c in a), None) for c in text]
    value = 0
    for c, a in zip(text, kinds):
        if a:
            value = value * len(a) + a.index(c)
    domain = 1
    for a in filter(None, kinds):
        domain *= len(a)
    if domain == 1:
        return text
    shape = "".join(c if a is None else str(alphabets.index(a)) for c, a in zip(text, kinds))
    value, out = permuted(value, domain, key, f"{tweak}/{shape}"), []
    for c, a in zip(reversed(text), reversed(kinds)):
        if a:
            value, at = divmod(value, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


def filled(form: str, digits: str) -> str:
    """``form`` with its digits replaced, in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isascii() and c.isdigit() else c for c in form)


def luhn(digits: str) -> int:
    """The check digit for these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def card(found: str, key: bytes) -> str | None:
    digits = only_digits(found)
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]):
        return None
    body = permuted_digits(digits[:-1], key, "card")
    return filled(found, f"{body}{luhn(body)}")


def address(found: str, key: bytes) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def phone(found: str, key: bytes) -> str | None:
    """The country code stays; a number without separators keeps its first one or two digits."""
    digits = only_digits(found)
    if not 8 <= len(digits) <= 15:
        return None
    code = 0
    if found.startswith("+"):
        code = len(re.match(r"\+(\d*)", found)[1])
        if code > 3:
            code = 1 if digits[0] in "17" else 2
    return filled(found, digits[:code] + permuted_digits(digits[code:], key, "phone"))


def social(found: str, key: bytes) -> str | None:
    def valid(digits: str) -> bool:
        area = digits[:3]
        return area not in ("000", "666") and area[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"

    digits = only_digits(found)
    if not valid(digits):
        return None
    while True:  # walks on until it is valid again
        digits = permuted_digits(digits, key, "social")
        if valid(digits):
            return filled(found, digits)


def date(found: str, key: bytes) -> str | None:
    """Year first, else day or month first, whichever is a date (day first if both are).

    Days up to 12 and days after 12 are permuted each among themselves. So a month-first
    date stays one that cannot be read day first, and all spellings of a date move alike.
    """
    parts = re.split(r"[-/.]", found)
    if len(parts[0]) == 4:
        orders = [(0, 1, 2)]
    else:
        orders = [(2, 1, 0), (2, 0, 1)]
    for year, month, day in orders:
        try:
            value = datetime.date(int(parts[year]), int(parts[month]), int(parts[day]))
        except ValueError:
            continue
        if FIRST_DAY <= value <= LAST_DAY:
            span = (LAST_DAY - FIRST_DAY).days + 1
            new = value
            while new == value or (new.day > 12) != (value.day > 12):
                new = FIRST_DAY + datetime.timedelta(permuted((new - FIRST_DAY).days, span, key, "date"))
                if new == value:  # a walk that comes back holds no other date of its kind
                    break
            fields = {year: f"{new.year:04d}", month: f"{new.month:02d}", day: f"{new.day:02d}"}
            return filled(re.sub(r"\d+", lambda m: "0" * max(2, len(m[0])), found), "".join(fields[i] for i in range(3)))
    return None


def account(found: str, key: bytes) -> str | None:
    """International account numbers: the check digits are computed anew."""

    def rest(code: str) -> int:
        return int("".join(str(int(c, 36)) for c in code)) % 97

    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or rest(plain[4:] + plain[:4]) != 1:
        return None
    body = permuted_text(plain[4:], key, "account")
    check = 98 - rest(body + plain[:2] + "00")
    moved = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(moved) for c in found)


def email(found: str, key: bytes) -> str | None:
    name, _, host = found.rpartition("@")
    return f"{permuted_text(name, key, 'email')}@{host}"


def secret(found: str, key: bytes) -> str | None:
    head, mark, value = re.match(r"(.*?)([0-9A-Fa-f]+)(\"?\Z)", found, re.S).groups()
    hexes = ("0123456789abcdef",) if mark.islower() or mark.isdigit() else ("0123456789ABCDEF",)
    if mark.lower() != mark and mark.upper() != mark:
        return head + permuted_text(mark, key, "secret") + value
    return head + permuted_text(mark, key, "secret", hexes) + value


#: In this order at each place; a value that fails its check is left to the next kind.
NUMBERS: tuple[tuple[str, Callable, re.Pattern], ...] = tuple(
    (name, rule, re.compile(pattern))
    for name, rule, pattern in (
        ("ip", address, r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
        ("date", date, r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d/-]|\.\d)"),
        ("social", social, r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
        (
            "card",
            card,
            r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1(?:\d{4}\1\d{1,3}|\d{1,7})|\d{4}([ -])\d{6}\2\d{5})(?!\d)",
        ),
        (
            "phone",
            phone,
            r"\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
            r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,8}(?:[ .-]\d{2,8}){0,4}(?!\.?\d)|\+\d{8,15}(?!\d)"
            r"|\(\d{3}\)[ ]?\d{3}[-. ]\d{4}(?!\d)|(?<![\d.-])\d{3}([-. ])\d{3}\1\d{4}(?![\d-])",
        ),
    )
)
#: Behind the sign of an address, and before it, read backwards; a name has at most 64 characters.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
EMAIL_NAME = re.compile(r"[\w.%+-]{1,64}")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
SECRET = re.compile(
    r"(?i:token|secret|password|api[_-]?key)\s*[=:]\s*\"?[0-9A-Fa-f]{16,}\"?", re.A
)
#: Text that a number of any kind lies in.
NUMERIC = re.compile(r"\+?\(?\d[\d ().+/-]{5,}\d")
MAYBE = re.compile(r"[0-9@]")
GROUP_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
#: More characters than a number other than a phone number has, and what must not follow it.
LONGEST = 40


Value = tuple[int, int, str]


def next_value(
    pattern: re.Pattern, rule: Callable, text: str, at: int, key: bytes,
    stop: int | None = None, free: Callable[[int, int], bool] | None = None,
) -> Value | None:
    """Start, end and pseudonym of the first value from ``at`` on that passes its check.

    A match that fails is tried with shorter ends, at each end of a group, and then from the
    next start inside it. ``free`` tells which stretches may be taken.
    """
    stop = len(text) if stop is None else stop
    m = pattern.search(text, at, stop)
    while m:
        start, end = m.span()
        inner = None
        while end > start:
            if end == m.end() or pattern.fullmatch(text, start, end):
                new = rule(text[start:end], key)
                if new is not None and (free is None or free(start, end)):
                    return start, end, new
            if inner is None:
                inner = [g.start() for g in GROUP_END.finditer(text, start + 1, end) if g.start() < end]
            end = inner.pop() if inner else start
        m = pattern.search(text, start + 1, stop)
    return None


def next_email(text: str, at: int, key: bytes) -> Value | None:
    """The first address from ``at`` on, found from its sign, so that long runs cost no search."""
    sign = text.find("@", at)
    while sign >= 0:
        host = EMAIL_HOST.match(text, sign)
        name = host and EMAIL_NAME.match(text[max(at, sign - 64) : sign][::-1])
        if name:
            start, end = sign - name.end(), host.end()
            return start, end, email(text[start:end], key)
        sign = text.find("@", sign + 1)
    return None


def numbers(span: str, key: bytes, kinds: list[str]) -> str:
    """The values of a numeric stretch replaced, leftmost first.

    A phone number, which has no check digit, ends before a value of another kind rather
    than inside it.
    """

    def free(start: int, end: int) -> bool:
        for name, rule, pattern in NUMBERS:
            at, stop = start + 1, min(len(span), end + LONGEST)
            while name != "phone" and (v := next_value(pattern, rule, span, at, key, stop)) and v[0] < end:
                if v[1] > end:
                    return False
                at = v[1]
        return True

    out, at = [], 0
    ahead: dict[str, Value | None] = {}
    while True:
        for name, rule, pattern in NUMBERS:
            if name not in ahead or (ahead[name] and ahead[name][0] < at):
                ahead[name] = next_value(pattern, rule, span, at, key, free=free if name == "phone" else None)
        name = min((n for n in ahead if ahead[n]), key=lambda n: ahead[n][0], default=None)
        if name is None:
            return "".join(out) + span[at:]
        start, end, new = ahead[name]
        out += [span[at:start], new]
        kinds.append(name)
        at = end


def pseudonymised(text: str, key: bytes) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kind of each value replaced."""
    kinds: list[str] = []
    if not MAYBE.search(text):
        return text, kinds

    def apply(find: Callable[[str, int], Value | None], name: str, part: str) -> list:
        """Stretches of ``part``; replaced ones as one-element tuples."""
        out, at = [], 0
        while value := find(part, at):
            start, end, new = value
            kinds.append(name)
            out += [part[at:start], (new,)]
            at = end
        return [*out, part[at:]]

    parts: list = [text]
    for name, find in (
        ("secret", lambda part, at: next_value(SECRET, secret, part, at, key)),
        ("email", lambda part, at: next_email(part, at, key)),
        ("account", lambda part, at: next_value(ACCOUNT, account, part, at, key)),
    ):
        parts = [q for p in parts for q in ([p] if isinstance(p, tuple) else apply(find, name, p))]
    return "".join(
        p[0] if isinstance(p, tuple) else NUMERIC.sub(lambda m: numbers(m[0], key, kinds), p) for p in parts
    ), kinds


def pseudonyms(docs: DataFrame, key: bytes = b"set the key of the corpus here") -> DataFrame:
    """``docs`` with values in ``text`` replaced, and ``n_values`` and ``kinds`` behind.

    Only ``text`` is read. Null texts stay null and have no values; each row is handled
    alone, so repeated rows and equal values come out alike. ``kinds`` names the kinds
    found, sorted. Input columns with these two names are replaced. A number that fails
    its check (such as a card number with a wrong last digit) is no value and stays, but
    values inside it that begin and end with its groups are replaced. Of valid values that
    overlap, the leftmost is taken; a phone number gives way to the others.
    """
    docs = docs.drop("n_values", "kinds")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            found = [
                (None, []) if t is None else pseudonymised(t, key) for t in batch.column("text").to_pylist()
            ]
            new = {
                "text": pa.array([t for t, _ in found], batch.schema.field("text").type),
                "n_values": pa.array([len(k) for _, k in found], pa.int64()),
                "kinds": pa.array([sorted(set(k)) for _, k in found], pa.list_(pa.string())),
            }
            names = [*batch.schema.names, "n_values", "kinds"]
            columns = [new[n] if n in new else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [
        *docs.schema.fields,
        T.StructField("n_values", T.LongType()),
        T.StructField("kinds", T.ArrayType(T.StringType())),
    ]
    return docs.mapInArrow(task, T.StructType(fields))


def private(docs: DataFrame, key: bytes = b"set the key of the corpus here") -> DataFrame:
    """``docs`` with pseudonyms in their texts, ``n_chars`` counted anew where they have it."""
    own = [c for c in ("text", "n_chars") if c in docs.columns]
    got = pseudonyms(wrapped(docs, *own), key)
    if "n_chars" in own:
        n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        got = got.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return got.select(*unwrapped(docs, *own))
