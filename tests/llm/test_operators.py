"""Operators on small literal tables: nulls, empty and long texts, ties, repeats, clashes."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.llm import dedup, language, mixing, packing, pii, quality, sharding, token_files, topk, warc
from evalspark.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the cat sat on the mat and looked at the dog by the door of the house in the sun "
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
ROWS = [
    (1, PROSE * 4, "en", "a", 5),
    (2, PROSE * 4, "en", "a", 5),
    (2, PROSE * 4, "en", "a", 5),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t", "fr", "b", 3),
    (None, "no id but words", None, "c", 3),
    (None, None, "en", None, None),
    (7, LONG, "en", "a", len(LONG)),
    (8, "12345 !!! ###", "de", "c", 13),
    (9, "short", "en", "", 5),
    (9, "another text under the same id", "en", "a", 5),
]
#: Names of result and helper columns of the operators.
CLASHES = (
    "size source_size target taken start length offset tier sequence_id digest class_id bands "
    "lang_pred score kinds n_values shard slot size n_words w kept rank n part node query_id"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.select("*", *[F.lit("x").alias(c) for c in dict.fromkeys(CLASHES)])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


OPERATORS = {
    "near_duplicates": (dedup.near_duplicates, ["doc_id", "class_id"]),
    "mixed": (mixing.mixed, ["doc_id", "size", "source_size", "target", "taken"]),
    "mix_rows": (mixing.mix_rows, ["doc_id", "text"]),
    "token_files": (token_files.token_file_round_trip, ["doc_id", "start", "n_tokens", "ids_crc32"]),
    "pseudonyms": (pii.pseudonyms, ["doc_id", "text", "n_values", "kinds"]),
    "packing": (packing.pack_documents, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]),
    "identify": (language.identify, ["doc_id", "held_out", "lang_pred", "score"]),
    "known_language": (language.known_language, ["doc_id", "text"]),
    "quality": (quality.quality, ["doc_id", "n_words", "base_failed", "kept"]),
    "sharded": (sharding.sharded, ["doc_id", "shard", "slot"]),
    "distinct": (dedup.distinct_documents, ["doc_id", "text"]),
    "private": (pii.private, ["doc_id", "text", "n_chars"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_empty_results(empty, name):
    job, columns = OPERATORS[name]
    assert job(empty).select(*columns).collect() == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("packing", "sharded")])
def test_other_columns_do_not_matter(docs, clashing, name):
    job, columns = OPERATORS[name]
    assert tuples(job(clashing), *columns) == tuples(job(docs), *columns)


def test_near_duplicates_of_odd_rows(docs):
    got = Counter(tuples(dedup.near_duplicates(docs), "doc_id", "class_id"))
    assert got[(1, 1)] == 1 and got[(2, 1)] == 2
    assert got[(3, 3)] == got[(4, 4)] == got[(5, 5)] == 1 and got[(None, None)] == 2
    assert got[(9, 9)] == 2 and sum(got.values()) == len(ROWS)


def test_distinct_documents_keep_one_of_each_class(docs):
    got = Counter(r.doc_id for r in dedup.distinct_documents(docs).collect())
    assert got == Counter([1, 3, 4, 5, None, None, 7, 8, 9, 9])
    again = docs.where("doc_id = 2")
    assert dedup.distinct_documents(again).count() == 1
    assert dedup.distinct_documents(docs).columns == docs.columns


def test_links_through_a_third_text_and_repeated_shingles(spark):
    words = [f"w{i}" for i in range(100)]

    def changed(*places):
        return " ".join("x" if i in places else w for i, w in enumerate(words))

    rows = [
        (10, changed()),
        (11, changed(20)),  # 0.90 to 10
        (12, changed(20, 60)),  # 0.90 to 11, 0.81 to 10
        (13, changed(20, 60, 80)),  # 0.90 to 12, less than 0.8 to 10
        (20, "a b c d e f " * 10),
        (21, "a b c d e f " * 20),  # the same set of shingles, half the multiset
        (30, " ".join(words[:50])),  # half of 10
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(tuples(dedup.near_duplicates(docs), "doc_id", "class_id"))
    assert got == {10: 10, 11: 10, 12: 10, 13: 10, 20: 20, 21: 21, 30: 30}


def test_a_class_takes_its_smallest_known_id(spark):
    rows = [(None, "same words in both of the texts"), (5, "same words in  both of the texts")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(dedup.near_duplicates(docs), "doc_id", "class_id") == [(5, 5), (None, 5)]
    assert [r.doc_id for r in dedup.distinct_documents(docs).collect()] == [5]


def test_parts_are_found_along_a_path(spark):
    edges = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(60) if i % 20 != 19]
    got = dedup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert {bytes(r.node): bytes(r.part) for r in got} == {
        f"{i:04d}".encode(): f"{i // 20 * 20:04d}".encode() for i in range(61) if i < 60
    }


def test_mix_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (i % 90 + 1)), None if i % 7 == 0 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs).select("source", "size", "source_size", "target", "taken").toPandas()
    by = got.groupby("source", dropna=False).agg(
        size=("size", "sum"), same=("source_size", "first"), target=("target", "first"), taken=("taken", "sum")
    )
    assert (by["size"] == by["same"]).all()
    assert (abs(by["taken"] - by["target"]) <= 45).all()
    assert abs(by["target"].sum() - 1.5 * by["size"].sum()) < 1e-6
    assert (got["taken"] <= 2 * got["size"]).all() and (by["target"] <= 2 * by["size"] + 1e-9).all()
    again = mixing.mixed(docs.repartition(13)).select("doc_id", "taken")
    assert tuples(again, "doc_id", "taken") == tuples(mixing.mixed(docs), "doc_id", "taken")


def water(sizes, weights, total, most):
    """Shares by weight, those above their bound fixed and the rest shared again."""
    bound, free = {}, set(sizes)
    while free:
        left = total - sum(bound.values())
        each = left / sum(weights[s] for s in free)
        over = {s for s in free if each * weights[s] > most * sizes[s]}
        if not over:
            return bound | {s: each * weights[s] for s in free}
        bound |= {s: most * sizes[s] for s in over}
        free -= over
    return bound


def test_targets_are_shared_again_until_none_is_above(spark):
    sizes = {f"s{i}": n for i, n in enumerate([10, 500, 40, 3, 700, 0, 90, 1, 60])}
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    want = water(sizes, weights, 1.5 * sum(sizes.values()), 2)
    got = {r.source: r.target for r in mixing.mixed(docs).collect()}
    assert got == pytest.approx(want)


def test_mixed_rows_repeat_what_is_taken(docs):
    taken = {r.text: r.taken / r.size for r in mixing.mixed(docs).collect() if r.size}
    got = Counter(r.text for r in mixing.mix_rows(docs).collect())
    for text, copies in Counter(r[1] for r in ROWS if r[1] and r[1].split()).items():
        assert got[text] == taken[text] * copies
    assert mixing.mix_rows(docs).columns == docs.columns


def encoded(rows):
    from evalspark.llm import tokens

    t = tokens.WordCoder(tokens.default_path()).tokenizer
    return [
        (i, np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")) for i, x in rows
    ]


def test_token_files_in_order_of_id(docs, spark):
    want = sorted(encoded([r[:2] for r in ROWS]), key=lambda r: (r[0] is not None, r[0] or 0))
    got = token_files.token_file_round_trip(docs).orderBy("start").collect()
    start = 0
    assert [r.doc_id for r in got] == [i for i, _ in want]
    for row in got:
        assert row.start == start
        start += row.n_tokens
    crcs = Counter((i, len(a), zlib.crc32(a.tobytes())) for i, a in want)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == crcs


def test_files_roll_and_find_documents(spark):
    rows = [(3 * i - 90, f"text number {i} " * (i % 9)) for i in range(200)]
    folder = scratch_path(spark, "roll")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = token_files.write_token_files(docs, folder, most_ids=300)
    want = dict(encoded(rows))
    assert manifest.count() > 8
    for part in manifest.collect():
        with token_files.TokenFile(part.path) as file:
            assert len(file) == part.n_docs and file.n_ids == part.n_ids
            for i in range(len(file)):
                assert file.find(file.doc_id(i)) == i
                assert (file.document(i) == want[file.doc_id(i)]).all()
            assert file.find(10**9) is None
    assert tuples(token_files.read_token_files(manifest), "doc_id") == sorted(((i,) for i, _ in rows), key=repr)


def test_packing_holds_every_id_once(docs):
    want = Counter()
    for i, a in encoded([r[:2] for r in ROWS]):
        want[(i, len(a))] += len(a)
    pieces = packing.pack_documents(docs).toPandas()
    got = Counter()
    for p in pieces.itertuples():
        got[(None if p.doc_id != p.doc_id else int(p.doc_id), p.doc_tokens)] += p.length
    assert got == want
    for _, q in pieces.sort_values("offset").groupby("sequence_id"):
        assert q.offset.tolist() == [0, *np.cumsum(q.length)[:-1].tolist()] and q.length.sum() <= 2048


def test_pseudonyms_keep_nulls_and_clean_texts(docs):
    got = pii.pseudonyms(docs.select("doc_id", "text"))
    assert tuples(got, "doc_id", "text") == tuples(docs, "doc_id", "text")
    assert {r.n_values for r in got.collect()} == {0}


def test_equal_values_are_linked_across_documents(spark):
    rows = [(i, f"document {i} has 4111111111111111 and a.b{i}@x.org") for i in range(20)]
    got = pii.pseudonyms(spark.createDataFrame(rows, "doc_id long, text string"), key=b"k").collect()
    cards = {r.text.split()[3] for r in got}
    assert len(cards) == 1 and cards != {"4111111111111111"}
    assert len({r.text.split()[5] for r in got}) > 15
    assert all(r.n_values == 2 and r.kinds == ["card", "email"] for r in got)


def test_language_of_odd_rows(docs):
    got = {r.doc_id: r for r in language.identify(docs).collect() if r.doc_id is not None}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (3, 4, 5, 8))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1].held_out == (zlib.crc32(b"1") % 3 == 1)


def test_labels_of_held_out_documents_are_not_learned(spark):
    rows = [(i, f"text {i}", "yy" if zlib.crc32(str(i).encode()) % 3 == 1 else "xx") for i in range(60)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in got.collect()} == {"xx"}


def test_nothing_to_learn_from_gives_und(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language.identify(docs).collect()] == [("und", 0.0)]


def test_quality_of_odd_rows(docs):
    got = {r.doc_id: r for r in quality.quality(docs).collect() if r.doc_id not in (None, 9)}
    assert not any(got[i].kept for i in (3, 4, 5, 8))
    assert got[1].n_words == got[1].n_repeat_words == 80 and got[1].base_failed
    assert got[7].n_words == 60_000 and got[7].n_repeat_words == 0


def test_repeats_are_found_beside_windows_of_like_hashes(spark):
    # The first 40 bits of the hashes of both windows agree.
    a, b = "w125648 p q", "w1059905 p q"
    rows = [(1, f"{a} x {b} y {a}", "en")]
    (got,) = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert got.n_words == 11 and got.n_repeat_words == 6


def test_quality_tells_symbols_from_prose(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["the", "of", "and", "to", *(f"{a}{b}ing" for a in "bcdfgh" for b in "aeiou")]

    def prose():
        return " ".join(rng.choice(vocabulary, 150)) + "."

    rows = [(i, prose(), "en") for i in range(60)] + [(99, prose().replace(" ", " $$$ ### "), "en")]
    rows += [(98, " ".join(f"xq{i}zv" for i in range(150)), "en")]
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.doc_id for r in got.collect() if not r.kept} == {98, 99}


def test_quality_counts_common_words_of_any_length(spark):
    rng = np.random.default_rng(5)
    common = [f"{a}{b}ischen" for a in "bdfg" for b in "aeio"]
    rows = [(i, " ".join(rng.choice(common, 150)), "de") for i in range(60)]
    rows += [(99, " ".join(f"q{a}{b}vxzknm" for a in "bcdfghjklm" for b in "bcdfghjklmnpqrs"), "de")]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[99].base_failed and got[99].js_chars < 0.1
    assert {i for i, r in got.items() if not r.kept} == {99}


def test_empty_vectors_meet_each_other(spark):
    rows = [(0, []), (1, []), (2, []), (3, [1.0]), (4, None)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    assert tuples(got, "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 0), (0, 2, 2, 0)]


def test_shards_are_even_and_slots_have_no_gaps(docs, spark):
    for df in (docs, spark.range(1003).select(F.col("id").alias("doc_id")).repartition(7)):
        got = sharding.sharded(df, 8).select("shard", "slot").collect()
        sizes = Counter(r.shard for r in got)
        assert sum(sizes.values()) == df.count() and max(sizes.values()) - min(sizes.values()) <= 1
        assert sorted(map(tuple, got)) == [(s, i) for s in sorted(sizes) for i in range(sizes[s])]


def test_every_place_is_as_likely(spark):
    df = spark.range(64).select(F.col("id").alias("doc_id")).coalesce(4)
    seen = np.zeros((4, 4))
    for seed in range(25):
        for r in sharding.sharded(df, 4, seed).collect():
            seen[r.doc_id // 16, r.shard] += 1
    expected = 25 * 64 / 16
    assert ((seen - expected) ** 2 / expected).sum() < 35  # 9 degrees of freedom


def test_slots_are_shuffled(spark):
    df = spark.range(800).select(F.col("id").alias("doc_id")).coalesce(1)
    got = sharding.sharded(df, 2).orderBy("shard", "slot").collect()
    first = [r.doc_id for r in got if r.shard == 0]
    assert abs(np.corrcoef(first, np.arange(len(first)))[0, 1]) < 0.2


VECTORS = "vec_id long, embedding array<float>, label int"


def best(rows, k):
    out = []
    usable = [(i, np.floor(np.array(v, float) * 1024)) for i, v, _ in rows if i is not None and v is not None
              and all(x is not None and np.isfinite(x) for x in v)]
    for q, x in {i: x for i, x in reversed(usable) if i % 100 == 0}.items():
        scored = [(-int(x @ y), i) for i, y in usable if i != q and len(y) == len(x)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 10, 500])
def test_top_k_with_ties_nulls_and_lengths(spark, k):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype("f4")], 0) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5], 1) for i in range(300, 420)]  # one vector many times
    rows += [(1000, None, 0), (1001, [1.0, None, 0.0, 0.0], 0), (1100, [float("nan")] * 4, 0)]
    rows += [(1200, [1.0, 2.0], 0), (1300, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [1.0] * 4, 0)]
    rows += [(1400, [], 0), (301, [0.5, 0.5, 0.5, 0.5], 1)]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = topk.top_k(vectors, F.col("vec_id") % 100 == 0, k)
    assert sorted(map(tuple, got.collect())) == best(rows, k)


def test_top_k_with_large_components(spark):
    rows = [(i, [3e9 * (i + 1), -1e5 * i], 0) for i in range(20)]
    got = topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0, 3).collect()
    assert [r.vec_id for r in got] == [1, 2, 3] or [r.rank for r in got] == [1, 2, 3]


def test_top_k_without_rows(spark):
    assert topk.top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") == 0).collect() == []


PAGES = "page_id long, url string, html string"


def test_archives_give_back_pages(spark):
    rows = [
        (1, "http://a/", "<p>same</p>"),
        (5, "http://b/", "<p>same</p>"),
        (3, None, "<p>same</p>"),
        (5, "http://b/", "<p>same</p>"),
        (4, "http://c/\n", None),
        (6, "", ""),
        (None, "http://d/", "<p>same</p>"),
        (7, "http://é/", "WARC/1.1\r\n\r\n" + "é" * 100_000),
        (None, None, "alone"),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).withColumn("kind", F.lit(0))
    got = warc.archive_round_trip(pages, roll_bytes=200)
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        top = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        first = page_id == top
        want.append((page_id, len(data), warc.digest(data), "response" if first else "revisit", None if first else top))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], PAGES)
    got = warc.archive_round_trip(pages, least_bytes=3).collect()
    assert {r.record_type for r in got} == {"response"}


def test_archives_are_the_same_in_every_run(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i % 3}</p>") for i in range(50)], PAGES)

    def files(df):
        manifest = warc.write_archives(df, scratch_path(spark, "warc"))
        return {r.name: open(r.path.removeprefix("file:"), "rb").read() for r in manifest.collect()}

    assert files(pages) == files(pages)


def test_no_pages_no_archives(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).collect() == []
