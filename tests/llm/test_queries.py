"""Registered queries on the smallest test data: against their SQL or brute force."""

import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import check
import corpus_pipeline
from evalspark.llm import pii, tokens
from evalspark.llm.catalog import ORACLE, QUERIES
from evalspark.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(base):
    return {i: t or "" for i, t in base.execute("select doc_id, text from documents").fetchall()}


@pytest.fixture(scope="module")
def ids(texts):
    t = tokens.WordCoder(tokens.default_path()).tokenizer
    return {i: np.array(t.encode(x, add_special_tokens=False).ids + [1], "<u4") for i, x in texts.items()}


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", ORACLE)
def test_query_agrees_with_sql(spark, base, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = base.execute(ORACLE[name])
    theirs = check.table([d[0] for d in cursor.description], cursor.fetchall())
    assert check.table(df.columns, df.collect()) == theirs


def classes(texts):
    """Classes by comparing all pairs that share a shingle."""
    bags, having = {}, defaultdict(list)
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        bags[i] = Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter()
        for s in bags[i]:
            having[s].append(i)
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    equal = {}
    pairs = {(a, b) for own in having.values() for a in own for b in own if a < b}
    pairs |= {(equal.setdefault(t, i), i) for i, t in sorted(texts.items())}
    for a, b in pairs:
        common = sum((bags[a] & bags[b]).values())
        if texts[a] == texts[b] or common >= 0.8 * (sum((bags[a] | bags[b]).values())):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in texts}


def test_near_duplicates(spark, texts):
    assert {r.doc_id: r.class_id for r in rows(spark, "op1_bag_minhash")} == classes(texts)


def test_mix(spark, texts):
    got = QUERIES["op2_pareto_mix"](spark, SF_DIR).toPandas().set_index("doc_id")
    source = table(spark, SF_DIR, "documents").select("doc_id", "source").toPandas().set_index("doc_id").source
    assert {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()} == got["size"].to_dict()
    by = got.groupby(source, dropna=False)
    assert (by["size"].sum() == by.source_size.first()).all()
    assert (abs(by.taken.sum() - by.target.first()) <= by["size"].max() / 2 + 1).all()
    assert by.target.first().sum() == pytest.approx(1.5 * got["size"].sum())


def test_token_files(spark, ids):
    start = 0
    for r in sorted(rows(spark, "op3_elias_fano_files"), key=lambda r: r.doc_id):
        a = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(a), zlib.crc32(a.tobytes()))
        start += len(a)
    assert start == sum(map(len, ids.values()))


def test_packing(spark, ids):
    got = QUERIES["op5_tiered_packing"](spark, SF_DIR).toPandas()
    assert set(got.doc_id) == set(ids)
    for i, pieces in got.sort_values("start").groupby("doc_id"):
        at = 0
        for p in pieces.itertuples():
            assert p.start == at and p.doc_tokens == len(ids[i])
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[i][p.start : at].tobytes())
        assert at == len(ids[i])
    padding = 0
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        n = int(s.length.sum())
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1].tolist()] and n <= 2048
        padding += 2048 - n if n & (n - 1) else 0
    assert padding <= 2048  # at most one padded sequence to a task


def test_pseudonyms(spark, texts):
    for r in rows(spark, "op4_feistel_pseudonyms"):
        new, kinds = pii.pseudonymised(texts[r.doc_id], b"set the key of the corpus here")
        assert (r.text, r.n_values) == (new, len(kinds))
        for card in re.findall(r"(?<!\d)\d{16}(?!\d)", texts[r.doc_id]):
            if pii.luhn(card[:-1]) == int(card[-1]):
                assert card not in r.text
        if not re.search(r"[0-9@]", texts[r.doc_id]):
            assert r.text == texts[r.doc_id] and not r.n_values


def test_languages_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF_DIR, "documents").collect()}
    got = rows(spark, "op6_language")
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert len(got) == len(lang) and np.mean(held) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_base_counts(spark, texts):
    for r in rows(spark, "op7_divergence_rules"):
        text = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(w, w[1:], w[2:]))
        inside = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
        assert want == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_shards(spark, texts):
    got = rows(spark, "op9_hypergeometric_shards")
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(8) for i in range(sizes[s])]


def test_pipeline_keeps_its_promises(spark, texts):
    docs = table(spark, SF_DIR, "documents")
    after, names = [docs], docs.columns
    for _, stage in corpus_pipeline.STAGES:
        after.append(stage(spark, after[-1], SF_DIR))
    for df in after[1:-1]:
        assert df.columns == names
    known, single, private, mixed = (d.select("doc_id", "text").collect() for d in after[1:5])
    assert {r.doc_id for r in known} >= {i for i, t in texts.items() if len(t.split()) > 50}
    kept = {r.doc_id: r.text for r in known}
    assert Counter(r.doc_id for r in single) == Counter(set(classes(kept).values()))
    assert {r.doc_id: r.text for r in private} == {
        r.doc_id: pii.pseudonymised(r.text, b"set the key of the corpus here")[0] for r in single
    }
    assert {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in private}
    copies = Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 2
    pieces = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "length", "start").toPandas()
    starts = pieces[pieces.start == 0].groupby("doc_id").size().to_dict()
    assert starts == dict(copies)
