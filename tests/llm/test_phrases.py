"""Counting quotient filters, and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.llm import phrases, quotient_filter
from evalspark.llm.quotient_filter import QuotientFilter


def grams(rng, n, lanes, top):
    return [rng.integers(1, top, n, dtype=np.uint64, endpoint=True) for _ in range(lanes)]


@pytest.mark.parametrize("lanes", [2, 3, 4, 5])
@pytest.mark.parametrize("top", [3, 250, 70_000, 20_000_000, 2**40])
def test_permutations_can_be_undone(lanes, top):
    bits = quotient_filter.lane_bits(top)
    own = grams(np.random.default_rng(lanes), 500, lanes, top)
    moved = quotient_filter.permuted(own, bits)
    assert all((lane < (1 << bits)).all() for lane in moved)
    back = quotient_filter.restored(moved, bits)
    assert all((a == b).all() for a, b in zip(own, back))
    rows = quotient_filter.packed(own, bits)
    assert rows.shape[1] == -(-lanes * bits // 8)
    number = [sum(int(x) << bits * (lanes - 1 - i) for i, x in enumerate(gram)) for gram in zip(*own)]
    assert [int.from_bytes(row.tobytes(), "big") for row in rows] == number
    assert all((a == b).all() for a, b in zip(own, quotient_filter.unpacked(rows, bits, lanes)))


def test_every_pair_of_a_small_domain_has_its_place():
    own = [x.astype(np.uint64) for x in np.divmod(np.arange(1 << 16), 256)]
    rows = quotient_filter.packed(quotient_filter.permuted(own, 8), 8)
    assert len(np.unique(rows, axis=0)) == 1 << 16
    # Neighbours are spread over all quotients.
    first = np.bincount(quotient_filter.packed(quotient_filter.permuted([x[:4096] for x in own], 8), 8)[:, 0], minlength=256)
    assert first.max() < 45


@pytest.mark.parametrize("n", [0, 1, 2, 300, 5000])
@pytest.mark.parametrize("lanes, top", [(2, 9), (2, 200), (3, 70_000), (5, 20_000_000)])
@pytest.mark.parametrize("skip", [0, 1, 5, 9])
def test_filters_lose_nothing(n, lanes, top, skip):
    bits = quotient_filter.lane_bits(top)
    skip = quotient_filter.unused_bits(lanes, bits) + min(skip, lanes * bits // 2)
    own = grams(np.random.default_rng(n), n, lanes, top)
    if n:
        own = [np.r_[lane, lane[:1].repeat(700)] for lane in own]  # a count beyond one byte
    want = Counter(zip(*[lane.tolist() for lane in own]))
    if not n:
        empty = QuotientFilter(np.zeros((0, 6), np.uint8), np.zeros(0))
        assert empty.parts(skip) == [] and len(QuotientFilter.from_bytes(empty.to_bytes())) == 0
        return
    whole, places = quotient_filter.counted(own, bits)
    assert places.max() == len(whole) - 1 and len(whole) == len(want)
    got = Counter()
    ends = 0
    for part in whole.parts(skip):
        data = part.to_bytes()
        again = QuotientFilter.from_bytes(data)
        assert (again.rows == part.rows).all() and (again.counts == part.counts).all() and again.part == part.part
        ends += len(data)
        lanes_back = quotient_filter.restored(quotient_filter.unpacked(again.rows, bits, lanes), bits)
        got.update(dict(zip(zip(*[lane.tolist() for lane in lanes_back]), again.counts.tolist())))
    assert got == want
    row = whole.rows[places[0]]
    assert whole.count(row) == want[tuple(int(lane[0]) for lane in own)]
    assert whole.count(np.full_like(row, 255)) in (0, int(whole.counts[-1]))
    if n == 5000 and len(whole.parts(skip)) == 1 and top > 250:
        assert ends < len(whole) * (lanes * bits / 8 + 1)  # less than plain rows and counts


def test_merged_filters_have_the_sums():
    rng = np.random.default_rng(7)
    lists = [grams(rng, n, 3, 12) for n in (500, 1, 80, 2000)]
    filters = [quotient_filter.counted(own, 8)[0] for own in lists]
    merged, places = QuotientFilter.merged(filters)
    both = [np.concatenate([own[i] for own in lists]) for i in range(3)]
    want = quotient_filter.counted(both, 8)[0]
    assert (merged.rows == want.rows).all() and (merged.counts == want.counts).all()
    for own, at in zip(filters, places):
        assert (merged.rows[at] == own.rows).all()


def brute(rows, least, longest, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least}
        scored = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in often.items()
            )
            if inside:
                continue
            cut = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cut)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["New", "york", "city", "a\x0bb", "é", "É", "the", "of", "x" * 300, "İ"] + [f"w{i}" for i in range(30)]
    fixed = ["new York city hall of fame", "as soon as possible", "é é é é é é é"]
    rows = [(None, None), ("en", ""), ("de", " \t\n.,;"), ("", "q q q. q q"), (None, "und und und")]
    for i in range(250):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(40))]
        text = "".join(p + rng.choice([" ", " ", "\t ", ". ", "\n", ",", "  "]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None]), text))
    return rows + rows[-20:]


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20, 1 << 25), (300, 64, 2000), (50, 1000, 20_000)])
def test_collocations(spark, corpus, sizes):
    docs = spark.createDataFrame(corpus, "lang string, text string").repartition(3)
    clash = docs.select("*", *[F.lit(0).alias(c) for c in ("ids", "word", "n", "score", "chunk", "phrase", "a", "rank")])
    got = phrases.collocations(clash, 8, 5, 60, *sizes)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(corpus, 8, 5, 60)


def test_shorter_phrases_only(spark, corpus):
    docs = spark.createDataFrame(corpus, "lang string, text string")
    got = phrases.collocations(docs, 10, 2, 5)
    assert sorted(map(tuple, got.collect())) == brute(corpus, 10, 2, 5)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "too few words")]])
def test_nothing_frequent(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert phrases.collocations(docs).collect() == []


def test_products_beyond_64_bits(spark):
    big = [(3 * 10**13, 9 * 10**15, 4 * 10**13, 10**14 - 1), (100, 10**16 - 1, 100, 100), (7, 50, 13, 11)]
    rows = spark.createDataFrame(big, "a long, n long, l long, r long")
    got = [r[0] for r in rows.select(phrases.score("a", "n", "l", "r")).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in big]
