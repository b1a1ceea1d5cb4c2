"""Collecting, parsing and checking answers; tool calls; prompts."""

import json

import pytest
from pyspark.sql import functions as F

from evalspark.functions import fixed
from evalspark.functions.parsing import Rule
from evalspark.operators import answers, prompts, toolcalls
from evalspark.operators.toolcalls import Tool
from tests.conftest import rows


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id LONG, raw STRING")


# --- collecting ----------------------------------------------------------------------


def flaky(row):
    if row["id"] % 3 == 0:
        raise ValueError("bad " + str(row["id"]))
    return row["raw"].upper()


def test_batch_answer_marks_failures(spark):
    asked = texts(spark, "a", "b", "c", "d")
    got = rows(answers.batch_answer(asked, flaky, max_attempts=2, partitions=3), "id")
    assert got == [
        (0, "a", None, False, 2, "ValueError: bad 0"),
        (1, "b", "B", True, 1, None),
        (2, "c", "C", True, 1, None),
        (3, "d", None, False, 2, "ValueError: bad 3"),
    ]


def test_distinct_calls_ask_once_per_input(spark, tmp_path):
    folder = str(tmp_path)

    def record(row):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(row["raw"]))
        return str(row["raw"]) + "!"

    asked = texts(spark, "x", "y", "x", None, "x", None)
    got = rows(answers.distinct_calls(asked, ["raw"], record), "id")
    assert [r[2] for r in got] == ["x!", "y!", "x!", "None!", "x!", "None!"]
    assert len(list(tmp_path.iterdir())) == 3


# --- structured answers ------------------------------------------------------------------


def test_parse_structured_is_strict(spark):
    good = {"task": "t", "question": "q", "answer": "a", "explanation": None, "more": 1}
    raw = texts(
        spark,
        json.dumps(good),
        '{"task":"t","question":"q","answer":5}',
        '{"task":"t","question":"q"}',
        '{"task":null,"question":"q","answer":"a"}',
        "no json",
        '["t"]',
        None,
        '{"task":"t","question":"q","answer":"a","explanation":7}',
    )
    parsed = answers.parse_structured(raw)
    got = {r["id"]: r for r in parsed.collect()}
    assert (got[0]["answer"], got[0]["explanation"], got[0]["success"]) == ("a", None, True)
    problems = {i: r["violations"] for i, r in got.items()}
    assert problems == {
        0: [],
        1: ["answer: type"],
        2: ["answer: missing"],
        3: ["task: type"],
        4: ["json: invalid"],
        5: ["json: invalid"],
        6: ["json: invalid"],
        7: ["explanation: type"],
    }
    assert all(got[i]["answer"] == "" for i in range(1, 8))
    assert answers.accepted(parsed).count() + answers.rejected(parsed).count() == raw.count()


def test_repeated_keys_in_answers_keep_the_last(spark):
    raw = texts(spark, '{"task":"t","question":"q","answer":"old","answer":"new"}')
    assert answers.parse_structured(raw).first()["answer"] == "new"


def test_schema_rules(spark):
    rules = [
        Rule("unit", enum=("bpm", "bps")),
        Rule("rate", kind="number"),
        Rule("text", pattern=r"^[0-9]+\s?(?:bpm|bps)$", required=False),
        Rule("password", min_length=8, required=False),
        Rule("tags", kind="array", required=False),
    ]
    raw = texts(
        spark,
        '{"unit":"bpm","rate":72.5,"text":"80 bpm","password":"12345678","tags":[]}',
        '{"unit":"x","rate":"72","text":"eighty","password":"short","tags":{}}',
        '{"rate":3}',
    )
    got = rows(answers.check_schema(raw, rules))
    assert got == [
        (1, "password: length"),
        (1, "rate: type"),
        (1, "tags: type"),
        (1, "text: pattern"),
        (1, "unit: enum"),
        (2, "unit: missing"),
    ]


def test_first_valid_attempt(spark):
    tries = spark.createDataFrame(
        [(1, 1, "x", False), (1, 2, "y", True), (1, 3, "z", True), (2, 1, "a", False),
         (2, 4, "b", True), (3, 1, "c", None)],
        "id LONG, attempt INT, answer STRING, valid BOOLEAN",
    )
    assert rows(answers.first_valid_attempt(tries, 3), "id") == [
        (1, "y", True, 2),
        (2, None, False, 3),
        (3, None, False, 1),
    ]


def test_reasoning_and_fence(spark):
    raw = texts(
        spark,
        "<think>\nwhy\nso </think>\n\n```json\n[1]\n```",
        "no tags ",
        "late</think> x",
        "<think>open",
    )
    split = answers.split_reasoning(raw)
    assert rows(split.select("id", "thoughts", "answer"), "id") == [
        (0, "why\nso", "```json\n[1]\n```"),
        (1, "", "no tags"),
        (2, "", "x"),
        (3, "", "<think>open"),
    ]
    assert answers.strip_fence(split).orderBy("id").first()["answer"] == "[1]"


# --- tool calls ------------------------------------------------------------------------------


def test_tool_calls_need_a_list_of_full_objects(spark):
    texts_ = [
        '[{"name":"a","parameters":{"k":1,"z":[1,2]}},{"name":"b","parameters":{}}]',
        '{"name":"a","parameters":{}}',
        '[{"name":"a"}]',
        "[]",
        "words",
        '[{"name":"a","parameters":null}]',
        '```json\n[{"name":"c","parameters":{"q":"v"}}]\n```',
        '[1, {"name":"a","parameters":{}}]',
        '\n [{"name":"d","parameters":{}}] ',
    ]
    df = spark.createDataFrame(list(enumerate(texts_)), "id LONG, answer STRING")
    calls = toolcalls.extract_tool_calls(df)
    got = rows(calls.select("id", "pos", "name", F.to_json("parameters").alias("p"), "parameters_ok"))
    assert [g[:3] for g in got] == [(0, 0, "a"), (0, 1, "b"), (5, 0, "a"), (6, 0, "c"), (8, 0, "d")]
    assert json.loads(got[0][3]) == {"k": "1", "z": "[1,2]"}
    assert [g[4] for g in got] == [True, True, False, True, True]
    assert rows(toolcalls.direct_answers(df).select("id")) == [(1,), (2,), (3,), (4,), (7,)]


def test_argument_errors(spark):
    registry = {"search": Tool(("q",)), "show": Tool(("uid",), ("full",))}
    df = spark.createDataFrame(
        [
            (1, '[{"name":"search","parameters":{"q":"x"}}]'),
            (2, '[{"name":"search","parameters":{"z":"x"}}]'),
            (3, '[{"name":"show","parameters":{"uid":"x","full":"1","y":"2"}}]'),
            (4, '[{"name":"drop","parameters":{}}]'),
            (5, '[{"name":"show","parameters":"uid"}]'),
        ],
        "id LONG, answer STRING",
    )
    got = toolcalls.analyse_tool_calls(df, registry).select("id", "missing", "extra", "error")
    assert rows(got, "id") == [
        (1, [], [], None),
        (2, ["q"], ["z"], "missing arguments"),
        (3, [], ["y"], "extra arguments"),
        (4, [], [], "unknown tool"),
        (5, ["uid"], [], "invalid arguments"),
    ]
    calls = toolcalls.extract_tool_calls(df)
    assert rows(toolcalls.unknown_tools(calls, registry).select("id")) == [(4,)]
    assert rows(toolcalls.bad_arguments(calls, registry).select("id")) == [(2,), (3,), (5,)]
    assert rows(toolcalls.tool_usage(calls, registry)) == [
        ("drop", 1, 1, 1.0),
        ("search", 2, 1, 0.5),
        ("show", 2, 2, 1.0),
    ]


def test_final_answer_respects_the_cap(spark):
    turns = spark.createDataFrame(
        [
            ("a", 0, "user", "q"), ("a", 1, "assistant", "first"), ("a", 2, "assistant", ""),
            ("a", 7, "assistant", "late"), ("b", 0, "user", "q"), ("b", 1, "tool", "t"),
            ("c", 1, "assistant", None),
        ],
        "conv_id STRING, turn LONG, role STRING, text STRING",
    )
    assert rows(toolcalls.final_answer(turns, fixed.MAX_TURNS_HOSTED)) == [
        ("a", "first", True),
        ("b", fixed.NOT_ANSWERED, False),
        ("c", fixed.NOT_ANSWERED, False),
    ]


# --- prompts ------------------------------------------------------------------------------------


def items(spark):
    return spark.createDataFrame(
        [(1, "t1", "Q {one}?", "A1"), (2, "t2", "Q2", None)],
        "id LONG, task STRING, question STRING, answer STRING",
    )


def test_messages(spark):
    built = prompts.build_messages(items(spark), "sys", [("user", "u"), ("assistant", "v")])
    got = built.orderBy("id").first()["messages"]
    assert [tuple(m) for m in got] == [
        ("system", "sys"), ("user", "u"), ("assistant", "v"), ("user", "Q {one}?"),
    ]
    assert len(prompts.build_messages(items(spark), "sys").first()["messages"]) == 2


def test_messages_from_example_sets(spark):
    shots = spark.createDataFrame(
        [("t1", 1, "assistant", "b"), ("t1", 0, "user", "a")],
        "task STRING, pos INT, role STRING, content STRING",
    )
    sets = prompts.few_shot_array(shots, "task")
    got = {
        r["id"]: [m["content"] for m in r["messages"]]
        for r in prompts.build_messages(items(spark), "s", sets, "task").collect()
    }
    assert got == {1: ["s", "a", "b", "Q {one}?"], 2: ["s", "Q2"]}
    late = shots.withColumn("pos", F.col("pos") + 2000)
    assert len(prompts.few_shot_array(late, "task").first()["examples"]) == 2


def test_templates_keep_braces_of_values(spark):
    got = prompts.structured_prompt(items(spark)).orderBy("id").first()["prompt"]
    assert got.startswith('Here is a question: "Q {one}?".\n')
    assert '{"task": str, "question": str' in got
    assert "The 'task' should be 't1'." in got


def test_judge_and_pairwise_prompts(spark):
    replies = spark.createDataFrame(
        [(1, "m1", "x"), (1, "m2", "y"), (2, "m1", "z"), (1, "m3", "w")],
        "id LONG, model STRING, answer STRING",
    )
    judged = prompts.judge_prompt(
        items(spark), replies.select("id", F.col("answer").alias("candidate")), "be strict"
    )
    assert judged.count() == 4
    assert all("Rubric: be strict\n" in r["prompt"] for r in judged.collect())
    pairs = prompts.pairwise_prompt(replies, "m1", "m2", "accuracy", items(spark)).collect()
    assert [(p["id"], p["model_a"], p["model_b"]) for p in pairs] == [(1, "m1", "m2")]
    assert "Response A:\nx\n" in pairs[0]["prompt"]


def test_pairwise_answers_made_from_few_rows_are_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(300).write.parquet(path)
    made = spark.read.parquet(path).select(
        "id", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.lit("a").alias("answer")) for m in (0, 1)]))
    )
    asked = spark.read.parquet(path).select("id", F.lit("q").alias("question"))
    got = prompts.pairwise_prompt(made, 0, 1, "accuracy", asked)
    assert got.count() == 300
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2


def test_append_turns(spark):
    schema = "conv_id LONG, turn LONG, role STRING, text STRING"
    history = spark.createDataFrame([(1, 0, "system", "s"), (1, 4, "user", "u")], schema)
    new = spark.createDataFrame([(1, 0, "assistant", "a"), (1, 1, "tool", "t"), (2, 0, "user", "n")], schema)
    got = rows(prompts.append_turns(history, new))
    assert got == [
        (1, 0, "system", "s"), (1, 4, "user", "u"), (1, 5, "assistant", "a"),
        (1, 6, "tool", "t"), (2, 0, "user", "n"),
    ]
