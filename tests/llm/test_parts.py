"""The parts of the text operators that need no session."""

import datetime
import io
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from evalspark.llm import dedup, language, packing, pii, sharding, tokens, warc
from evalspark.llm.elias_fano import EliasFano


@pytest.mark.parametrize("count", [0, 1, 2, 5, 255, 256, 257, 3000])
@pytest.mark.parametrize("top", [1, 10, 10**6, 2**50])
def test_elias_fano_gives_back_every_number(count, top):
    values = np.sort(np.random.default_rng(count).integers(0, top, count)).astype(np.uint64)
    data = EliasFano.of(values).to_bytes()
    got = EliasFano.from_bytes(data)
    assert (got.values() == values).all()
    assert [got[i] for i in range(count)] == values.tolist()
    assert (got.values(count // 3, count // 2) == values[count // 3 : count // 2]).all()
    if count == 3000 and top == 10**6:
        assert len(data) < 3000 * 12 / 8 + 300  # not 8 bytes each


def test_elias_fano_refuses_falling_numbers():
    with pytest.raises(ValueError):
        EliasFano.of(np.array([3, 2]))


def test_words_have_the_ids_of_whole_texts():
    coder = tokens.WordCoder(tokens.default_path(), most_bytes=1000)
    for text in (
        "",
        " \n\t",
        "It's Don't stop!! End.",
        "Éé ÑÑ, ß. ΑΣ İx '’s",
        "a b c\x1cd\x85e",
        "<|endoftext|> x<|startoftext|>y",
        "é ́x 12,5 ... ,, ?!a!",
        "日本語 text 123abc.",
    ):
        ids = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text.encode()), coder.dtype).tolist() == [*ids, 1]


def test_distinct_words_of_a_slice_are_looked_at_once():
    coder = tokens.WordCoder(tokens.default_path())
    assert coder.split
    asked = Counter()
    make = coder.pieces.make
    coder.pieces.make = lambda piece: asked.update([piece]) or make(piece)
    coder.words.make = lambda word: asked.update([word]) or coder._word(word)
    # Marks that end words are pieces too; the words they end are no words of their own.
    rows = ["Éa### xy&&& XY*** 'S xy's ſĿ", None, "", "xy éA###\x0bx<|endoftext|> a<b xy|>", "日本 a\x1cb ŉa İa ĸ"]
    want = [coder._ids(text or "") + [1] for text in rows]
    column = pa.array(["unread", *rows], pa.string()).slice(1)
    assert [ids.tolist() for ids in coder.encode_all(column)] == want
    assert max(asked.values()) == 1 and not {"xy&&&", "XY***", "XY"} & set(asked)
    assert asked["xy"] == asked["###"] == asked["éa"] == 1


def test_windows_are_full_and_hold_every_id_once():
    rng = random.Random(4)
    tiers = (2048, 1024, 512, 256)
    pieces = [
        packing.Piece(i, np.arange(n, dtype="<u2"), 0, n)
        for i, n in enumerate(rng.choice([1, 2, 100, 300, 1024, 1500, 2047]) for _ in range(500))
    ]
    want = sum(p.length for p in pieces)
    full, rest = packing.fill(list(pieces), tiers)
    assert all(sum(p.length for p in w) == t for t, w in full)
    closed = packing.close(rest, 2048, 64)
    padded = [w for _, w in closed if (n := sum(p.length for p in w)) & (n - 1)]
    assert len(padded) <= 1
    seen = sorted((p.doc_id, p.start, p.length) for _, w in full + closed for p in w)
    assert sum(n for *_, n in seen) == want
    at = {}
    for doc, start, length in seen:
        assert start == at.get(doc, 0)
        at[doc] = start + length
    cuts = len(seen) - len(pieces)
    assert cuts <= len(full) + len(closed)


def test_step_groups_have_equal_tokens_of_one_tier():
    windows = [(t, [packing.Piece(0, None, 0, t)]) for t in [2048] * 64 + [512] * 256]
    groups = packing.step_groups(windows, 1 << 16)
    sums, tiers = {}, {}
    for (tier, _), group in zip(windows, groups):
        sums[group] = sums.get(group, 0) + tier
        tiers.setdefault(group, set()).add(tier)
    assert set(sums.values()) == {1 << 16} and all(len(t) == 1 for t in tiers.values())


@pytest.mark.parametrize("domain", [1, 2, 3, 10, 97, 1000, 4096])
def test_feistel_permutes_its_domain(domain):
    got = [pii.permuted(i, domain, b"k", "t") for i in range(domain)]
    assert sorted(got) == list(range(domain))
    if domain > 90:
        assert got != [pii.permuted(i, domain, b"other", "t") for i in range(domain)]


@pytest.mark.parametrize(
    "text, kind, form",
    [
        ("pay 4111 1111 1111 1111 now", "card", r"pay \d{4} \d{4} \d{4} \d{4} now"),
        ("4111-1111-1111-1111", "card", r"\d{4}-\d{4}-\d{4}-\d{4}"),
        ("x 7536784127813050", "card", None),
        ("from 10.1.2.3.", "ip", r"from (\d+\.){3}\d+\."),
        ("+1 (017) 555-7713%%%", "phone", r"\+1 \(\d{3}\) \d{3}-\d{4}%%%"),
        ("+1 (826) 555-4081 190.137.223.204", "phone", None),
        ("on 2020-02-29", "date", r"on \d{4}-\d\d-\d\d"),
        ("31/12/1999", "date", r"\d\d/\d\d/\d{4}"),
        ("123-45-6789", "social", r"\d{3}-\d\d-\d{4}"),
        ("DE89370400440532013000", "account", r"DE\d{20}"),
        ("und.34@mail7.example.com", "email", r"[a-z]{3}\.\d\d@mail7\.example\.com"),
        ('token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', "secret", r'token = "[0-9a-f]{40}"'),
    ],
)
def test_values_change_within_their_format(text, kind, form):
    new, kinds = pii.pseudonymised(text, b"k")
    if form is None:
        assert kind in kinds
    else:
        assert kinds == [kind] and re.fullmatch(form, new)
    assert new != text and pii.pseudonymised(text, b"k")[0] == new


def test_replaced_numbers_still_pass_their_checks():
    for i in range(50):
        body = f"{i * 7919:015d}"
        new = pii.card(f"{body}{pii.luhn(body)}", b"k")
        assert pii.luhn(new[:-1]) == int(new[-1])
        datetime.date.fromisoformat(pii.date(f"19{i % 90 + 10}-0{i % 9 + 1}-11", b"k"))
        assert all(0 <= int(p) <= 255 for p in pii.address(f"1.2.{i}.4", b"k").split("."))
    code = pii.account("GB82 WEST 1234 5698 7654 32", b"k").replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


@pytest.mark.parametrize(
    "text",
    [
        "",
        "no numbers here",
        "4111111111111112",
        "300.1.1.1 and v1.2.3",
        "2020-13-45",
        "666-45-6789",
        "5,000,000 in 1999 and 2001, 3.14159, 12345678",
        "version 2.0. 16777216",
    ],
)
def test_what_fails_its_check_stays(text):
    assert pii.pseudonymised(text, b"k") == (text, [])


@pytest.mark.parametrize(
    "before, value, behind, kind",
    [
        ("2024 ", "4111 1111 1111 1111", "", "card"),
        ("2024-", "4111-1111-1111-1111", " 7", "card"),
        ("0001 0002 ", "4111 1111 1111 1111", " 123", "card"),
        ("no. 12 ", "4111 1111 1111 1111 110", " 2024", "card"),
        ("", "ES91 2100 0418 4502 0005 1332", " EUR", "account"),
        ("", "ES9121000418450200051332", " EUR", "account"),
        ("", "ES9121000418450200051332", " 2024", "account"),
        ("AB12 ", "ES91 2100 0418 4502 0005 1332", " EUR 2024", "account"),
        ("", "+44 20 7946 0958", " 2024 1234", "phone"),
    ],
)
def test_values_next_to_other_numbers_are_replaced(before, value, behind, kind):
    alone, _ = pii.pseudonymised(value, b"k")
    new, kinds = pii.pseudonymised(before + value + behind, b"k")
    assert alone != value and kinds == [kind] and new == before + alone + behind


def test_a_phone_number_ends_before_a_card():
    for phone in ("+44 20 7946 0958", "555 123"):
        new, kinds = pii.pseudonymised(f"{phone} 4111 1111 1111 1111", b"k")
        assert "card" in kinds and new.endswith(pii.card("4111 1111 1111 1111", b"k"))


def test_equal_values_in_other_forms_stay_linked():
    a, _ = pii.pseudonymised("4111111111111111", b"k")
    b, _ = pii.pseudonymised("4111 1111 1111 1111", b"k")
    assert b.replace(" ", "") == a


@pytest.mark.parametrize("marked, others, drawn", [(5, 7, 6), (1000, 7000, 500), (3 * 10**9, 2 * 10**10, 10**6)])
def test_hypergeometric_has_its_mean_and_spread(marked, others, drawn):
    rng = random.Random(1)
    got = np.array([sharding.hypergeometric(marked, others, drawn, rng) for _ in range(3000)])
    total = marked + others
    mean = drawn * marked / total
    var = mean * others / total * (total - drawn) / (total - 1)
    assert abs(got.mean() - mean) < 5 * (var / 3000) ** 0.5
    assert 0.85 < got.var() / var < 1.15


def test_matrix_has_both_sums():
    rng = random.Random(2)
    rows = [rng.randrange(5000) for _ in range(40)] + [0]
    shards = sharding.even_sizes(sum(rows), 7)
    got = sharding.matrix(rows, shards, rng)
    assert [sum(r) for r in got] == rows
    assert [sum(c) for c in zip(*got)] == shards


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    a = {i: int(rng.integers(1, 9)) for i in range(300)}
    b = dict(a) | {i: int(rng.integers(1, 9)) for i in range(60)} | {i: 3 for i in range(300, 330)}
    keys = sorted(set(a) | set(b))
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    found = []
    for turn in range(40):
        sets = []
        for x in (a, b):
            e = dedup.mix(dedup.mix(np.array(list(x), np.uint64) + np.uint64(99)) + np.uint64(turn))
            sets.append((e, np.array(list(x.values()))))
        owners = np.repeat([0, 1], [len(a), len(b)])
        elements, counts = (np.concatenate(x) for x in zip(*sets))
        s = dedup.signatures(elements, counts, owners, 2)
        found.append((s[0] == s[1]).mean())
    assert abs(np.mean(found) - true) < 4 * np.std(found) / len(found) ** 0.5 + 0.002


def test_signatures_of_tiny_and_heavy_documents_are_whole():
    elements = dedup.mix(np.arange(1, 4, dtype=np.uint64))
    got = dedup.signatures(elements, np.array([1, 100_000, 3]), np.array([0, 1, 2]), 3)
    assert got.all()


def test_occurrences_count_a_multiset():
    a = dedup.occurrences(b"a b c d e " * 3)
    b = dedup.occurrences(b"a b c d e " * 2)
    assert len(a) == 11 and len(b) == 6
    assert len(np.intersect1d(a, b)) == 6
    assert len(dedup.occurrences(b" \n ")) == 0 and len(dedup.occurrences(b"two words")) == 1


def test_records_survive_odd_headers_and_payloads():
    payload = b"\r\n\r\nWARC/1.1\r\n\xc3\xa9"
    data = warc.record(7, "http://x/\r\nEvil: 1 ", payload, None, "2024-01-01T00:00:00Z")
    data += warc.record(3, None, payload, 7, "2024-01-01T00:00:00Z")
    (h1, b1), (h2, b2) = warc.parse(io.BytesIO(data))
    assert b1.partition(b"\r\n\r\n")[2] == payload and "evil" not in h1
    assert h2["warc-type"] == "revisit" and h2["x-refers-to-page-id"] == "7"
    assert h2["warc-payload-digest"] == h1["warc-payload-digest"] and b2.endswith(b"\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(data[:-60])))


def test_grams_see_the_whole_text():
    assert len(language.grams("")) > 0
    a, b = (np.bincount(language.grams("x" * 5000 + end), minlength=1 << language.BITS) for end in "yz")
    assert (a != b).any()


def test_temperature_does_not_claim_certainty():
    logits = [np.array([2.0, -2.0])] * 50
    assert language.temperature(logits, [0] * 50) > 0.1
    assert language.temperature(logits, [0, 1] * 25) > 5
    assert language.temperature([], []) == 1.0


@pytest.mark.parametrize("form", ["{y:04d}-{m:02d}-{d:02d}", "{d:02d}/{m:02d}/{y:04d}", "{m:02d}.{d:02d}.{y:04d}"])
def test_dates_are_permuted_one_to_one(form):
    day, seen, moved = pii.FIRST_DAY, set(), {}
    while day <= pii.LAST_DAY:
        text = form.format(y=day.year, m=day.month, d=day.day)
        if text not in seen:
            seen.add(text)
            moved[text] = pii.date(text, b"k")
        day += datetime.timedelta(1)
    assert set(moved.values()) == seen


def test_spellings_of_a_date_move_alike():
    for day in (datetime.date(1999, 12, 31), datetime.date(2020, 2, 29), datetime.date(1950, 1, 5)):
        year_first = datetime.date.fromisoformat(pii.date(day.isoformat(), b"k"))
        assert pii.date(day.strftime("%d/%m/%Y"), b"k") == year_first.strftime("%d/%m/%Y")
        if day.day > 12:
            assert pii.date(day.strftime("%m/%d/%Y"), b"k") == year_first.strftime("%m/%d/%Y")


@pytest.mark.parametrize(
    "text", ["x" * 1_000_000 + "@", "@" * 300_000, "a@b." * 100_000, "x" * 1_000_000 + "@a.org", "a.b-" * 250_000]
)
def test_long_runs_are_searched_in_linear_time(text):
    started = time.perf_counter()
    pii.pseudonymised(text, b"k")
    assert time.perf_counter() - started < 5


def test_addresses_next_to_signs():
    new, kinds = pii.pseudonymised("@@ab@c@de.fg@host.org@x, u@v.w x", b"k")
    assert kinds == ["email"] and re.fullmatch(r"@@ab@[a-z]@de\.fg@host\.org@x, u@v\.w x", new)
