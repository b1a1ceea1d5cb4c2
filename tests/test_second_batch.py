"""Nested messages, documents by benchmark, lists as answers, verdicts, the vector index."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.operators import judging, lookups, projections, prompts, scoreboards, similarity
from evalspark.sources import readers, writers
from tests.conftest import rows

CALLS = "array<struct<name:string,arguments:string>>"
TURNS = f"conv_id long, turn long, role string, text string, calls {CALLS}, reply_to struct<turn:bigint,place:int>"


@pytest.mark.parametrize("block_turns", [1, 3, 1024])
def test_messages_name_the_calls_they_answer(spark, block_turns):
    data = [
        (1, 2, "tool", "r1", None, (1, 1)),
        (1, 0, "user", "ask", None, None),
        (1, 1, "assistant", None, [("a", "{}"), ("b", '{"x": 1}')], None),
        (1, 3, "tool", "r0", None, (1, 0)),
        (1, 900, "assistant", "done", None, None),
        (2, 5, "tool", "nobody asked", None, (9, 0)),
        (None, 0, "user", None, [], None),
    ]
    turns = spark.createDataFrame(data, TURNS).repartition(5)
    lists = prompts.message_lists(turns, block_turns)
    got = {r.conv_id: r.messages for r in lists.collect()}
    assert [m.turn for m in got[1]] == [0, 1, 2, 3, 900] and len(got) == 3
    calls = {c.id: c.name for c in got[1][1].tool_calls}
    assert [calls[m.tool_call_id] for m in got[1][2:4]] == ["b", "a"]
    assert rows(prompts.message_rows(lists)) == rows(turns)
    assert rows(prompts.loose_replies(lists)) == [(2, "call_9_0")]


def test_one_document_per_benchmark(spark, tmp_path):
    data = [
        ("x", "t\"1\n", "q{i}", "p", ["a"]), ("x", "t\"1\n", "q2", None, ["a", "b"]), ("x", "u", "", "ü", []),
        ("y", "t", "only", "1", None), ("y", None, "q", "z", ["z"]),
    ]
    df = spark.createDataFrame(data, "benchmark string, task string, question string, predicted string, true array<string>")
    writers.write_paired_documents(df.repartition(4), str(tmp_path / "d"))
    files = sorted((tmp_path / "d").glob("benchmark=*/part-*"))
    assert len(files) == 2
    assert [json.loads(f.read_text()) for f in files] == [
        {'t"1\n': {"q{i}": {"predicted": "p", "true": "a"}, "q2": {"predicted": None, "true": ["a", "b"]}},
         "u": {"": {"predicted": "ü", "true": []}}},
        {"": {"q": {"predicted": "z", "true": "z"}}, "t": {"only": {"predicted": "1", "true": None}}},
    ]
    assert readers.read_paired(spark, [str(f) for f in files]).count() == 5


def test_documents_hold_many_tasks_in_order(spark, tmp_path):
    df = spark.range(500).select(
        (F.col("id") % 2).alias("benchmark"), F.format_string("t%d", F.col("id") % 7).alias("task"),
        F.format_string("q%03d", F.col("id")).alias("question"),
        F.lit("p").alias("predicted"), F.array(F.lit("x")).alias("true"),
    )
    writers.write_paired_documents(df, str(tmp_path / "d"))
    for i in (0, 1):
        (file,) = (tmp_path / "d" / f"benchmark={i}").glob("part-*")
        doc = json.loads(file.read_text())
        assert sorted(q for questions in doc.values() for q in questions) == [f"q{n:03d}" for n in range(i, 500, 2)]
        assert list(doc) == sorted(doc)


def test_answers_as_lists(spark):
    tables = {
        "gene": spark.createDataFrame(
            [(1, "A", "e1", "4", "x", None), (2, "B", "e2", "7", "x", None), (3, "C", "e3", None, "x", None)],
            "uid long, symbol string, ensembl string, chromosome string, gene_type string, summary string",
        ),
        "gene_disease": spark.createDataFrame(
            [("d", 2, 1), ("d", 1, 2), ("none", 3, 1)], "disease string, uid long, rnk long"
        ),
    }
    items = spark.createDataFrame(
        [(i, "t", f"List chromosome locations of the genes related to {d}.", "g") for i, d in enumerate(["d", "none", "new"])]
        + [(9, "t", "no such kind", "g")],
        "id long, task string, question string, answer string",
    )
    kinds = ("disease_genes", "disease_loc")
    got = lookups.answer_by_lookup(items, tables, kinds=kinds, typed=True).select("id", "answers")
    answers = dict(rows(got))
    assert answers[0] == ["7", "4"] and answers[1] == answers[2] == ["NA"] and len(answers[9]) == 1
    plain = lookups.answer_by_lookup(items, tables, kinds=kinds)
    assert "answers" not in plain.columns and plain.where("id = 0").first().predicted == "7, 4"


@pytest.mark.parametrize(
    "text, score",
    [("Score: 4", 4), ("Score: 4.", 4), ("Score:5, good", 5), ("Score: 4.5", None), ("Score: 3,5", None), ("Score: 45", None),
     ("Score: 4/5", 4), ("Score: x", None), ("Score: 1\n2", 1)],
)
def test_fractions_are_no_scores(spark, text, score):
    read = judging.read_verdicts(spark.createDataFrame([(text,)], "verdict string"))
    assert read.first().judge_score == score


def test_answers_without_an_item_are_judged(spark):
    items = spark.createDataFrame([(1, "t", "q", "a")], "id long, task string, question string, answer string")
    answers = spark.createDataFrame([(1, "x"), (2, "y")], "id long, candidate string")
    got = {r.id: r.prompt for r in prompts.judge_prompt(items, answers, "r").collect()}
    assert set(got) == {1, 2} and "y" in got[2]


def test_gain_of_tools(spark):
    data = [("s", "t", False, 0.25), ("s", "t", True, 0.75), ("m", "t", False, 0.5)]
    results = spark.createDataFrame(data, "benchmark string, task string, tools boolean, score double").withColumn("success", F.lit(True))
    got = scoreboards.compare_runs(results, "tools", [False, True], ["benchmark", "task"])
    assert rows(got) == [("m", "t", 0.5, None, None), ("s", "t", 0.25, 0.75, 0.5)]


@pytest.fixture(scope="module")
def cloud(spark):
    """Vectors around 30 centres, odd ones among them."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    data = [(i, (centres[i % 30] + rng.normal(scale=0.35, size=24)).tolist()) for i in range(1500)]
    data += [(2000, None), (2001, [1.0, None] + [0.0] * 22), (2002, [float("nan")] * 24), (2003, []), (2004, [1.0, 2.0])]
    return spark.createDataFrame(data, "doc_id long, vector array<double>").repartition(4).cache()


def test_index_finds_most_neighbours(spark, cloud):
    queries = cloud.where("doc_id % 25 = 0").withColumnRenamed("doc_id", "query_id")
    exact = similarity.retrieve_top_k(queries, cloud.where("size(vector) = 24"), 10)
    index = projections.projection_index(cloud, tables=8, bits=11)
    assert index.count() == 1501 * 8
    found = projections.retrieve_by_index(queries.where("size(vector) = 24"), cloud, 10, index, tables=8, bits=11, probes=24)
    measured = projections.recall(found, exact.where("query_id < 1500")).first()
    assert measured.queries == 60 and measured.neighbours == 600 and measured.recall >= 0.9
    met = projections.probed_buckets(queries, tables=8, bits=11, probes=24).join(index, ["dim", "table", "bucket"]).select("query_id", "doc_id").distinct()
    assert met.count() < 0.5 * 60 * 1500  # far fewer than all pairs
    shared = found.alias("f").join(exact.alias("e"), ["query_id", "doc_id"])
    gap = shared.agg(F.max(F.abs(F.col("f.similarity") - F.col("e.similarity")))).first()[0]
    assert gap < 1e-9


def test_index_without_rows(spark, cloud):
    none = cloud.limit(0)
    assert projections.retrieve_by_index(none.withColumnRenamed("doc_id", "query_id"), cloud, 3).collect() == []
    short = cloud.where("doc_id = 2004").withColumnRenamed("doc_id", "query_id")
    assert [r.doc_id for r in projections.retrieve_by_index(short, cloud, 3).collect()] == [2004]


def test_met_pairs_are_no_rows(spark, cloud):
    docs = cloud.where("doc_id < 1500").unionByName(cloud.where("doc_id = 50"))
    queries = cloud.where("doc_id % 50 = 0 AND doc_id < 1500").withColumnRenamed("doc_id", "query_id")
    index = projections.projection_index(docs)
    found = projections.retrieve_by_index(queries, docs, 4, index, block_bytes=20_000)
    met = projections.probed_buckets(queries).join(index, ["dim", "table", "bucket"])
    pairs = {(r.query_id, r.doc_id) for r in met.select("query_id", "doc_id").distinct().collect()}
    data = [(r.doc_id, np.array(r.vector) / np.linalg.norm(r.vector)) for r in docs.collect()]
    own = {r.query_id: np.array(r.vector) / np.linalg.norm(r.vector) for r in queries.collect()}
    want = []
    for q, v in own.items():
        near = sorted((-round(float(v @ u), 9), d) for d, u in data if (q, d) in pairs)[:4]
        want += [(q, d, -s, place) for place, (s, d) in enumerate(near, 1)]
    got = [(r.query_id, r.doc_id, round(r.similarity, 9), r.place) for r in found.collect()]
    assert sorted(got) == sorted(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "bucket#" in line]
