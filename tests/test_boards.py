"""Scoreboards, pairing, judging, vectors, streaming, items."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.functions import fixed, vectors
from evalspark.operators import items, judging, pairing, scoreboards, similarity
from evalspark.session import scratch_path
from evalspark.sources import sums
from evalspark.streaming import scoreboard as streams
from tests.conftest import rows

RESULTS = "id LONG, task STRING, score DOUBLE, success BOOLEAN"


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(
        [(1, "a x", 1.0, True), (2, "a x", 0.0, False), (3, "a x", 0.5, True), (4, "b", None, True),
         (5, "b", float("nan"), True), (6, "b", 0.25, True)],
        RESULTS,
    )


def test_overall_is_the_row_mean(spark, results):
    got = {r["task"]: r for r in scoreboards.scoreboard(results).collect()}
    assert got["a x"]["score"] == 0.5
    assert got["b"]["score"] == 0.25
    assert got[None]["score"] == pytest.approx(1.75 / 4)
    assert got[None]["success_rate"] == pytest.approx(5 / 6)
    assert got[None]["is_total"] == 1
    assert scoreboards.overall_score(results).first()[0] == pytest.approx(1.75 / 4)
    keys = {r["key"]: r["value"] for r in scoreboards.metrics_long(scoreboards.scoreboard(results)).collect()}
    assert set(keys) == {"success_rate", "overall_score", "score_a_x", "score_b"}
    ordered = scoreboards.order_results(scoreboards.scoreboard(results)).collect()
    assert [r["task"] for r in ordered] == ["a x", "b", None]
    chart = {r["task"]: (r["score"], r["overall_score"]) for r in scoreboards.chart_table(results).collect()}
    assert chart["b"] == (0.25, pytest.approx(1.75 / 4))


def test_empty_scoreboard(spark):
    empty = spark.createDataFrame([], RESULTS)
    assert scoreboards.score_by_task(empty).count() == 0
    assert scoreboards.success_rate(empty).first()[0] is None


@pytest.mark.parametrize("block_bits", [1, 3, 20])
def test_running_score(spark, block_bits):
    ids = [0, 1, 2, 5, 6, 7, 63, 64, 65, 1 << 40, (1 << 40) + 3, 1 << 62]
    data = [(run, i, (i * 7 % 10) / 10) for run in ("r", "s") for i in ids]
    df = spark.createDataFrame(data, "run STRING, id LONG, score DOUBLE").repartition(5)
    got = scoreboards.running_score(df, block_bits=block_bits).where("run = 's'").orderBy("id").collect()
    scores = np.cumsum([(i * 7 % 10) / 10 for i in ids]) / np.arange(1, len(ids) + 1)
    assert [r["id"] for r in got] == ids
    assert [r["items"] for r in got] == list(range(1, len(ids) + 1))
    assert [r["score"] for r in got] == pytest.approx(list(scores))


def test_running_score_reads_its_input_once(spark, tmp_path, settings):
    settings(autoBroadcastJoinThreshold=-1)
    path = str(tmp_path / "r")
    spark.range(1000).select(
        (F.col("id") % 3).alias("run"), "id", F.rand(1).alias("score")
    ).write.parquet(path)
    df = scoreboards.running_score(spark.read.parquet(path), block_bits=4)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1


def test_models(spark):
    df = spark.createDataFrame(
        [(1, "t", 1.0, True, "m"), (2, "t", 0.0, True, "n"), (3, "u", 0.5, True, "m")],
        RESULTS + ", model STRING",
    )
    wide = scoreboards.compare_models(df, ["m", "n"])
    assert rows(wide) == [("t", 1.0, 0.0, -1.0), ("u", 0.5, None, None)]
    cube = {(r["model"], r["task"]): r["score"] for r in scoreboards.score_cube(df).collect()}
    assert cube[(None, None)] == 0.5
    assert cube[("m", None)] == 0.75
    both = scoreboards.union_runs(df.select("id", "task"), df.select("id", "model"))
    assert both.columns == ["id", "task", "model"]
    assert both.count() == 6


def test_coverage_and_pending(spark):
    asked = spark.createDataFrame([(i, "t" if i < 3 else "u") for i in range(4)], "id LONG, task STRING")
    done = spark.createDataFrame([(0, True), (0, True), (1, False)], "id LONG, success BOOLEAN")
    got = {r["task"]: (r["items"], r["answered"], r["coverage"]) for r in scoreboards.coverage(asked, done).collect()}
    assert got == {"t": (3, 2, pytest.approx(2 / 3)), "u": (1, 0, 0.0), None: (4, 2, 0.5)}
    assert rows(scoreboards.pending_items(asked, done).select("id")) == [(1,), (2,), (3,)]


@pytest.mark.parametrize(
    "coverage, exact, points",
    [(1.0, 0.21, 5), (1.0, 0.20, 4), (0.99, 0.5, 3), (0.9, 0.5, 2), (0.6, 0.5, 1), (0.5, 0.9, 0), (1.0, 0.0, 0)],
)
def test_threshold_band(spark, coverage, exact, points):
    df = spark.createDataFrame([(coverage, exact)], "coverage DOUBLE, exact_match DOUBLE")
    assert scoreboards.threshold_band(df).first()["points"] == points


# --- pairing ---------------------------------------------------------------------------


def test_pairing_by_question(spark):
    pred = spark.createDataFrame(
        [(1, " Q1? "), (2, f"Q2 {fixed.DECOMPOSE_SUFFIX}"), (3, "Q3"), (4, "Q4")],
        "id LONG, question STRING",
    )
    gold = spark.createDataFrame(
        [("t", "Q1?", ["a", "b"]), ("u", "Q1?", ["c"]), ("t", "Q2", ["d"]), ("t", "Q4", [])],
        "task STRING, question STRING, answers ARRAY<STRING>",
    )
    got = rows(pairing.pair_by_question(pred, gold).select("id", "gold_answer", "note"))
    assert got == [
        (1, "a", None), (1, "b", None), (1, "c", None), (2, "d", None),
        (3, None, fixed.NO_GOLD_NOTE), (4, None, fixed.NO_GOLD_NOTE),
    ]
    assert rows(pairing.unmatched(pred, gold).select("id")) == [(3,), (4,)]
    scored = spark.createDataFrame([(1, 0.5), (1, 1.0), (2, None)], "id LONG, score DOUBLE")
    assert rows(pairing.best_gold(scored)) == [(1, 1.0, 0.75, 2), (2, None, None, 0)]


# --- judging ---------------------------------------------------------------------------------


def test_verdicts(spark):
    df = spark.createDataFrame(
        [("t", "Score: 4\nExplanation: good\nreally"), ("t", "Score: 9"), ("t", "none"),
         ("u", "Score: 1"), ("u", "Score: 99999999999")],
        "task STRING, verdict STRING",
    )
    read = judging.read_verdicts(df).collect()
    assert [r["judge_score"] for r in read] == [4, None, None, 1, None]
    assert read[0]["explanation"] == "good\nreally"
    assert rows(judging.judge_report(df)) == [("t", 3, 4.0, 2 / 3), ("u", 2, 1.0, 0.5)]


def test_win_rate(spark):
    df = spark.createDataFrame(
        [("m", "n", "Choice: A"), ("m", "n", "Choice: B"), ("n", "m", "Choice: B"), ("m", "n", "?")],
        "model_a STRING, model_b STRING, verdict STRING",
    )
    got = rows(judging.win_rate(judging.read_verdicts(df)))
    assert got == [("m", "n", 3, 2 / 3), ("n", "m", 3, 1 / 3)]


# --- vectors -------------------------------------------------------------------------------------


def test_mean_pool_and_cosine(spark):
    df = spark.createDataFrame(
        [(1, [[1.0, 2.0], [3.0, 4.0], [9.0, 9.0]], [1, 1, 0]), (2, [[1.0, 0.0]], [0])],
        "id INT, tokens ARRAY<ARRAY<FLOAT>>, mask ARRAY<INT>",
    )
    pooled = df.select("id", vectors.mean_pool(F.col("tokens"), F.col("mask")).alias("v"))
    assert [r["v"] for r in pooled.orderBy("id").collect()] == [[2.0, 3.0], [0.0, 0.0]]
    unit = similarity.mean_pool(df).orderBy("id").collect()
    assert unit[0]["vector"] == pytest.approx([2 / math.sqrt(13), 3 / math.sqrt(13)])
    assert unit[1]["vector"] == [0.0, 0.0]


@pytest.mark.parametrize("block", [8 << 20, 4096])
def test_nearest_vectors_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    docs = rng.normal(size=(300, 6)).round(3)
    docs[100:200] = docs[0]  # a third of the vectors are copies
    docs[7] = 0.0
    queries = rng.normal(size=(20, 6)).round(3)
    queries[3] = docs[0]
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "doc_id LONG, vector ARRAY<DOUBLE>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id LONG, vector ARRAY<DOUBLE>")
    found = similarity.retrieve_top_k(q, d.repartition(6), 4, block_bytes=block)
    got = {}
    for r in found.orderBy("query_id", "place").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    norms = np.maximum(np.linalg.norm(docs, axis=1), 1e-12)
    for i, query in enumerate(queries):
        sims = np.round(docs @ query / norms / np.linalg.norm(query), 10)
        assert got[i] == list(np.lexsort((np.arange(300), -sims))[:4])


def test_no_queries_no_results(spark):
    d = spark.createDataFrame([(1, [1.0])], "doc_id LONG, vector ARRAY<DOUBLE>")
    q = spark.createDataFrame([], "query_id LONG, vector ARRAY<DOUBLE>")
    assert similarity.retrieve_top_k(q, d, 3).count() == 0


# --- items ------------------------------------------------------------------------------------------


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(500).select("id")
    a = rows(items.sample_items(df.repartition(7), 20, seed=1))
    b = rows(items.sample_items(df.coalesce(1), 20, seed=1))
    c = rows(items.sample_items(df, 20, seed=2))
    assert a == b and a != c and len(set(a)) == 20


# --- streaming -----------------------------------------------------------------------------------------


def test_stream_equals_its_batch_twin(spark, tmp_path):
    source = str(tmp_path / "in")
    base = spark.range(400).select(
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 97)).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("task"),
        (F.col("id") % 5 != 0).alias("success"),
        (F.col("id") % 7 / 7).alias("score"),
    )
    base.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(source)
    table, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    drained = streams.drain_scoreboard(stream, table, checkpoint).drop("batch")
    batch = streams.stream_scoreboard(spark.read.parquet(source))

    def shape(df):
        return rows(df.select("window_start", "task", "items", F.round("success_rate", 9), F.round("score", 9)))

    assert shape(drained) == shape(batch)
    again = streams.drain_scoreboard(stream, table, checkpoint)
    assert shape(again) == shape(batch)


def test_append_mode_writes_closed_windows_once(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts TIMESTAMP, task STRING, success BOOLEAN, score DOUBLE"
    hour = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600)
    rows_ = spark.range(100).select(
        hour.alias("ts"), F.lit("t").alias("task"), F.lit(True).alias("success"), F.lit(1.0).alias("score")
    )
    rows_.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    query = streams.start_scoreboard(stream, table, str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    closed = spark.read.parquet(table)
    assert closed.count() == closed.dropDuplicates(["window_start", "task"]).count()
    assert 70 <= closed.count() < 100


def test_scratch_path_is_new_each_time(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


# --- boards that grow ------------------------------------------------------------------------------------


def test_folded_results_count_once(spark, tmp_path):
    results = spark.range(90).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), (F.col("id") % 2).cast("string"))).alias("task"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 4 > 0).alias("success"),
        F.when(F.col("id") % 7 > 0, F.col("id") / 90).alias("score"),
        F.col("id"),
    )
    root = str(tmp_path / "board")
    with pytest.raises(ValueError):
        scoreboards.folded_scoreboard(spark, root)
    assert sums.next_batch(spark, root) == 0 and sums.compact(spark, root, ["task"]) is None
    for batch, rule in ((0, "id < 20"), (1, "id < 0"), (2, "id >= 20 AND id < 70"), (2, "id >= 20 AND id < 60")):
        scoreboards.fold_results(results.where(rule), root, batch)

    def same(rule):
        def shape(df):
            return rows(df.select("task", "is_total", "items", *[F.round(c, 9) for c in ("success_rate", "score_sum", "score")]))

        assert shape(scoreboards.folded_scoreboard(spark, root)) == shape(scoreboards.scoreboard(results.where(rule)))

    same("id < 60")
    assert sums.compact(spark, root, ["task"]) == 2 == sums.compact(spark, root, ["task"])
    same("id < 60")
    scoreboards.fold_results(results.where("id >= 60"), root, sums.next_batch(spark, root))
    same("true")
    # A base that was not finished does not count.
    (tmp_path / "board" / "bases" / "batch=000000000003").mkdir()
    same("true")


def test_late_rows_count_and_no_state_is_kept(spark, tmp_path):
    source = tmp_path / "in"
    schema = "ts TIMESTAMP, task STRING, success BOOLEAN, score DOUBLE"
    hours = [50, 3, 900, 3, 50]  # far out of order
    for i, hour in enumerate(hours):
        spark.range(4).select(
            F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hour)).alias("ts"), F.lit("t").alias("task"),
            F.when(F.col("id") > 0, F.col("id") > 1).alias("success"), F.col("id").cast("double").alias("score"),
        ).coalesce(1).write.parquet(str(source / f"f={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    out, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    drained = streams.drain_scoreboard(stream, out, str(checkpoint), compact_every=2)
    twin = streams.stream_scoreboard(spark.read.schema(schema).parquet(f"{source}/*"))
    columns = ["window_start", "task", "items", F.round("success_rate", 9), F.round("score", 9)]
    assert rows(drained.select(columns)) == rows(twin.select(columns))
    assert not (checkpoint / "state").exists()
    assert sums.next_batch(spark, out) == len(hours)


def test_bands_are_a_table(spark):
    scores = spark.createDataFrame(
        [("a", 0.8, 0.2), ("a", 1.0, 0.2), ("a", None, 0.9), ("b", 0.2, None), ("c", 1.0, 1.0), (None, 0.6, 0.6)],
        "scheme STRING, coverage DOUBLE, exact_match DOUBLE",
    )
    bands = [("a", 1, 0.5, None, 0.1), ("a", 5, None, 1.0, 0.1), ("b", 2, None, None, None), (None, 3, 0.5, None, None)]
    got = scoreboards.banded(scores, spark.createDataFrame(bands, scoreboards.BANDS))
    assert [r.points for r in got.orderBy("scheme", "coverage").collect()] == [3, 0, 1, 5, 2, 0]


def test_missing_success_is_no_success(spark):
    results = spark.createDataFrame([("t", True, 1.0), ("t", None, 0.5), (None, False, 0.0)], "task STRING, success BOOLEAN, score DOUBLE")
    assert scoreboards.success_rate(results).first()[0] == pytest.approx(1 / 3)
    board = scoreboards.scoreboard(results)
    assert board.where("is_total = 1").first().success_rate == pytest.approx(1 / 3)
    assert {r.key for r in scoreboards.metrics_long(board).collect()} == {"success_rate", "overall_score", "score_t", "score_"}
