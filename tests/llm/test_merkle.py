"""Merkle manifests: places in logs, trees by brute force, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from evalspark.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 3
        run = level[first : first + 3]
        out.append("".join("*" if first + k == i else d for k, d in enumerate(run)))
        i //= 3
    return out


@pytest.mark.parametrize("n", [*range(1, 60), 243, 244, 730])
def test_places_in_the_log(n):
    levels = tree([h(str(i)) for i in range(n)])
    height = merkle.levels_over(n, 64)
    nodes = merkle.postorder(levels[0], height)
    assert len(nodes) == sum(map(len, levels)) and height == len(levels) - 1
    for level, own in enumerate(levels):
        assert [nodes[merkle.position(level, i, n, height)] for i in range(len(own))] == own
    found = merkle.Paths("".join(nodes), n, height, "")
    assert all(found[i] == "/".join(path(levels, i)) for i in range(n))


ROWS = [(i, None if i % 7 == 0 else f"s{i % 4 if i % 5 else 0}", "a\n" * (i % 3)) for i in range(150)]
ROWS += [(500, "alone", "x"), (None, "s1", None), (None, "s1", None), (3, "s3", "a"), (3, "s3", "b"), (9, "", ""), (9, "é", "")]


def expected(rows):
    """Leaf, subroot, root, siblings' digest by row of ``rows`` (id, source, leaf)."""
    by = {}
    for i, source, leaf in rows:
        by.setdefault(source, []).append((i is not None, i or 0, leaf))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([leaf for *_, leaf in sorted(by[s])]) for s in sources]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, source in enumerate(sources):
        for i, (known, doc_id, leaf) in enumerate(sorted(by[source])):
            siblings = "".join(path(trees[k], i) + path(top, k)).replace("*", "")
            out.append((doc_id if known else None, source, leaf, trees[k][-1][0], top[-1][0], h(siblings)))
    return out


@pytest.mark.parametrize("block_levels", [1, 2, merkle.BLOCK_LEVELS])
def test_trees_of_any_block_size(spark, block_levels):
    docs = spark.createDataFrame(ROWS, "doc_id long, source string, text string").repartition(7)
    later = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    suspects = docs.select(
        "doc_id",
        "source",
        merkle.leaf("doc_id", "source", "text").alias("leaf"),
        merkle.leaf("doc_id", "source", later).alias("claimed"),
        *[F.lit("clash").alias(c) for c in ("tree", "index", "size", "path", "root", "block", "others", "nodes", "n")],
    )
    got = merkle.checked(suspects, block_levels).collect()
    rows = [(r.doc_id, r.source, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got]
    plain = [(r.doc_id, r.source, r.leaf) for r in suspects.collect()]
    assert sorted(rows, key=repr) == sorted(expected(plain), key=repr)
    texts = {(i, s): t for i, s, t in ROWS}
    for r in got:
        clean = r.doc_id is None or r.doc_id % 2 or "\n" not in (texts[r.doc_id, r.source] or "")
        assert r.verified == bool(clean) and (r.folded_root == r.root) == r.verified


def test_leaves_tell_null_empty_and_joined_values_apart(spark):
    rows = [(None, "x"), ("", "x"), ("a", "bc"), ("ab", "c"), ("-", "x"), ("é", None)]
    got = spark.createDataFrame(rows, "a string, b string").select(merkle.leaf("a", "b")).collect()
    assert [r[0] for r in got] == [h(t) for t in ("-1:x", "0:1:x", "1:a2:bc", "2:ab1:c", "1:-1:x", "2:é-")]


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, "s", "f" * 64, "f" * 64)], "doc_id long, source string, leaf string, claimed string")
    (r,) = merkle.checked(one).collect()
    assert r.root == r.subroot == r.leaf and r.verified and r.proof_sha256 == h("")
    assert merkle.checked(one.limit(0)).collect() == []
