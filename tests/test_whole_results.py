"""Nothing is cut, lost or changed: long lists, large numbers, null keys, odd vectors."""

import pytest
from pyspark.sql import functions as F

from evalspark.operators import answers, items, lookups, pairing, ranking, routing, scoreboards, similarity, toolcalls
from tests.conftest import rows


@pytest.mark.parametrize("k", [999, 1000, 1001])
def test_first_k_has_one_plan_and_takes_any_column(spark, k):
    hits = spark.range(3000).select(
        F.lit("q").alias("query"), (F.col("id") / 2).cast("long").alias("rank"), "id", F.create_map(F.lit("a"), "id").alias("m")
    )
    got = ranking.top_candidates(hits, k, ties=["id"])
    assert sorted(r["id"] for r in got.collect()) == list(range(k))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2


def test_calls_leave_large_numbers_alone(spark):
    df = spark.createDataFrame([(2**60 + 1, "a"), (None, "b")], "big LONG, x STRING")
    got = answers.batch_answer(df, lambda row: f"{row['x']}{row['big']}")
    assert rows(got.select("big", "raw_prediction"), "raw_prediction") == [(2**60 + 1, f"a{2**60 + 1}"), (None, "bNone")]


def test_retries_follow_the_policy(spark):
    def reply(row):
        raise (ValueError if row["id"] else TimeoutError)("no")

    got = answers.batch_answer(spark.range(2), reply, 3, retry_on=(TimeoutError,), delay=lambda n: 0.001 * n)
    assert rows(got.select("id", "attempts", "success")) == [(0, 3, False), (1, 1, False)]
    waits = [answers.doubling_delay(1, 0)(n) for n in (1, 2, 3)]
    assert waits == [1, 2, 4]


def test_rejected_answers_keep_their_item(spark):
    df = spark.createDataFrame([(1, "T", "Q", "not json")], "id INT, task STRING, question STRING, raw STRING")
    got = answers.parse_structured(df).first()
    assert (got["task"], got["question"], got["answer"], got["success"]) == ("T", "Q", "", False)


def routed(spark, *questions):
    df = spark.createDataFrame(list(enumerate(questions)), "id INT, question STRING")
    return [r[1:] for r in rows(routing.route_questions(df).select("id", "kind", "arg"), "id")]


def test_arguments_are_whole(spark):
    assert routed(
        spark,
        "Align the DNA sequence to the human genome:ACGT-N",
        "Which organism does the DNA sequence come from:ACGT\nTTGA",
        "What are genes related to A\nB?",
        "What is the official gene symbol of?",
    ) == [
        ("align", "ACGT-N"),
        ("organism", "ACGTTTGA"),
        ("disease_genes", "A\nB"),
        ("alias", None),
    ]


def test_final_answer_has_no_cap_unless_asked(spark):
    turns = spark.createDataFrame([("c", 9, "assistant", "late")], "conv_id STRING, turn INT, role STRING, text STRING")
    assert toolcalls.final_answer(turns).first()["answer"] == "late"
    assert not toolcalls.final_answer(turns, 7).first()["answered"]


def test_running_scores_keep_null_runs_and_ids(spark):
    df = spark.createDataFrame(
        [(None, 1, 1.0), (None, 2, 0.0), ("a", 1, 1.0), ("a", None, 1.0)], "run STRING, id LONG, score DOUBLE"
    )
    assert rows(scoreboards.running_score(df)) == rows(
        spark.createDataFrame(
            [(None, 1, 1, 1.0), (None, 2, 2, 0.5), ("a", 1, 1, 1.0), ("a", None, None, None)],
            "run STRING, id LONG, items LONG, score DOUBLE",
        )
    )


def test_odd_vectors_cost_no_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    docs = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [nan, 1.0]), (4, None), (5, [0.0, 1.0]), (6, [inf, 0.0]), (7, [1.0, None])],
        "doc_id LONG, vector ARRAY<DOUBLE>",
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id LONG, vector ARRAY<DOUBLE>")
    got = similarity.retrieve_top_k(queries, docs, 3)
    assert rows(got.select("query_id", "place", "doc_id")) == [(1, 1, 1), (1, 2, 2), (1, 3, 5)]
    assert rows(similarity.unusable_vectors(docs).select("doc_id")) == [(3,), (4,), (6,), (7,)]


def test_predictions_without_gold_stay(spark):
    pred = spark.createDataFrame([(1, [1.0]), (2, [1.0])], "id INT, vector ARRAY<DOUBLE>")
    got = rows(similarity.embedding_similarity(pred, pred.where("id = 1")), "id")
    assert got[0][1:] == (1.0, None) and got[1][1] is None and got[1][2]


def test_labels_are_made_distinct_before_they_are_compared(spark):
    labels = spark.createDataFrame([("TRUE",)] * 50 + [("x",)], "label STRING")
    got = items.shared_labels(labels, labels.where("label = 'TRUE'"))
    assert rows(got) == [("TRUE",)]


def test_reports_without_gene_do_not_meet_in_the_join(spark):
    tables = {
        "reports": spark.createDataFrame([(f"s{i}", "Status=FAILED") for i in range(20)], "sequence STRING, report STRING"),
        "gene_alias": spark.createDataFrame([("a", 1, 1)], "alias STRING, uid LONG, rnk LONG"),
        "gene": spark.createDataFrame([(1, "A")], "uid LONG, symbol STRING"),
    }
    book = lookups.sequence_alias_book(tables)
    assert {r["predicted"] for r in book.collect()} == {"NA"} and book.count() == 20


def test_pairs_by_id_can_keep_what_has_no_gold(spark):
    pred = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, raw_prediction STRING")
    gold = spark.createDataFrame([(1, "x")], "id INT, answer STRING")
    assert pairing.pair_by_id(pred, gold).count() == 1
    got = rows(pairing.pair_by_id(pred, gold, how="left").select("id", "gold_answer", "note"), "id")
    assert got[0] == (1, "x", None) and got[1][1] is None and got[1][2]
