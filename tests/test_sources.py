"""Files: readers, writers, run log."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from evalspark.session import scratch_path
from evalspark.sources import parsers, readers, runs, writers
from tests.conftest import rows


def put(path, text):
    path.write_text(text, encoding="utf8")
    return str(path)


def test_nested_benchmark(spark, tmp_path):
    first = {"Z task": {"q2": "a", "q1": ["b", "c"]}, "A task": {"q3": "NA", "q4": "[x]"}}
    put(tmp_path / "1.csv", json.dumps(first))
    put(tmp_path / "2.csv", '{"T": {"k": "old", "l": "x", "k": "new"}, "E": {}, "X": null, "N": {"n": null}}')
    got = rows(readers.read_nested_qa(spark, str(tmp_path)), "id")
    assert got == [
        (0, "Z task", "q2", ["a"]),
        (1, "Z task", "q1", ["b", "c"]),
        (2, "A task", "q3", ["NA"]),
        (3, "A task", "q4", ["[x]"]),
        (4, "T", "k", ["new"]),
        (5, "T", "l", ["x"]),
        (6, "N", "n", None),
    ]


def test_question_list(spark, tmp_path):
    doc = {
        "questions": [
            {"type": "summary", "body": "B1?", "ideal_answer": ["x", "y"], "id": "n"},
            {"type": "list", "body": "B2?", "ideal_answer": []},
        ],
        "none": None,
    }
    path = put(tmp_path / "q.json", json.dumps(doc, indent=2))
    assert rows(readers.read_question_list(spark, path), "id") == [
        (0, "summary", "B1?", "x", ["x", "y"]),
        (1, "list", "B2?", None, []),
    ]


def test_predictions_array_and_lines(spark, tmp_path):
    entries = [
        {"task": "t", "question": "q", "answer": "a\n\"b\"", "explanation": None, "success": True, "id": 3},
        {"task": "t", "question": "q2", "answer": "", "explanation": "", "success": False, "id": 4},
    ]
    array = put(tmp_path / "array.csv", json.dumps(entries, indent=2))
    read = readers.read_predictions(spark, array)
    assert rows(read, "id") == [
        (3, "t", "q", 'a\n"b"', None, True),
        (4, "t", "q2", "", "", False),
    ]
    target = str(tmp_path / "lines")
    writers.write_predictions(read, target)
    assert rows(readers.read_predictions(spark, target, multi_line=False)) == rows(read)


def test_paired_document_and_fragments(spark, tmp_path):
    doc = {"t": {"q": {"predicted": "p", "true": ["a", "b"]}, "r": {"predicted": None, "true": "x"}},
           "u": {"q": {"predicted": ["1", "2"], "true": ""}}}
    read = readers.read_paired(spark, put(tmp_path / "d.json", json.dumps(doc)))
    expected = [
        ("t", "q", ["p"], ["a", "b"]),
        ("t", "r", None, ["x"]),
        ("u", "q", ["1", "2"], [""]),
    ]
    assert rows(read) == expected
    target = tmp_path / "fragments"
    writers.write_paired(read, str(target))
    assert rows(readers.read_paired(spark, str(target), lines=True)) == expected
    merged = {}
    for part in target.glob("part-*"):
        for line in part.read_text().splitlines():
            for task, questions in json.loads(line).items():
                merged.setdefault(task, {}).update(questions)
    assert merged == doc


def test_results_keep_na_nulls_and_newlines(spark, tmp_path):
    data = [
        (1, "t", 'q, "x"\nline', "NA", "NA", "NA", 1.0, True),
        (2, "t", " q ", "", None, None, 0.0, False),
        (3, "t", "q", "a\\b", "", "x", None, True),
    ]
    df = spark.createDataFrame(data, readers.RESULT_SCHEMA)
    path = tmp_path / "csv"
    writers.write_results(df, str(path))
    assert rows(readers.read_results(spark, str(path)), "id") == data
    part = next(path.glob("part-*"))
    with open(part, newline="") as f:
        assert next(csv.reader(f))[:3] == ["id", "task", "question"]


def test_item_lines(spark, tmp_path):
    items = spark.createDataFrame([(1, "t", "q", "NA"), (2, "t", 'q"2', "x")], readers.ITEM_SCHEMA)
    writers.write_items(items, str(tmp_path / "i"))
    assert rows(readers.read_items(spark, str(tmp_path / "i"))) == rows(items)


def test_results_table_is_partitioned(spark, tmp_path):
    df = spark.range(4).select("id", (F.col("id") % 2).alias("model"))
    path = str(tmp_path / "t")
    writers.write_results_table(df, path, ["model"])
    writers.write_results_table(df, path, ["model"])
    read = spark.read.parquet(path).where("model = 1")
    assert read.count() == 4
    assert "PartitionFilters: [isnotnull(model" in read._jdf.queryExecution().executedPlan().toString()


def keyed(tmp_path, name, key, replies):
    lines = [json.dumps({key: k, "value": v if isinstance(v, str) else json.dumps(v)}) for k, v in replies]
    return put(tmp_path / name, "\n".join(lines))


def test_search_docs(spark, tmp_path):
    path = keyed(tmp_path, "s", "term", [
        ("a", {"esearchresult": {"count": "3", "idlist": ["9", "7", "8"]}}),
        ("b", {"esearchresult": {"idlist": []}}), ("c", {"error": 1}), ("d", "not json"),
    ])
    assert rows(readers.read_search_docs(spark, path, 2)) == [("a", 1, "9"), ("a", 2, "7")]
    assert readers.read_search_docs(spark, path).count() == 3


def test_summary_docs(spark, tmp_path):
    reply = {"result": {"uids": ["5", "6"],
                        "5": {"uid": "5", "name": "N", "chromosome": "4", "nomenclaturesymbol": "S",
                              "organism": {"scientificname": "Homo sapiens", "taxid": 9606}},
                        "6": {"uid": "6", "summary": "long"}}}
    path = put(tmp_path / "d", json.dumps(reply))
    assert rows(readers.read_summary_docs(spark, path), "uid") == [
        ("5", "N", "4", "S", None, None, "Homo sapiens", None),
        ("6", None, None, None, None, None, None, "long"),
    ]


def test_snp_docs(spark, tmp_path):
    def reply(key, body):
        return json.dumps({"result": {"uids": [key], key: body}})

    text = "\n".join([
        reply("1", {"chr": "13", "genes": [{"name": "A"}, {"id": 1}]}),
        reply("2", {"chr": "2", "genes": {"name": "B"}}),
        reply("3", {"genes": []}),
        reply("4", {}),
        reply("5", {"genes": {}}),
    ])
    assert rows(readers.read_snp_docs(spark, put(tmp_path / "d", text)), "rsid") == [
        ("1", "13", ["A", "NA"]),
        ("2", "2", ["B"]),
        ("3", None, []),
        ("4", None, ["NA"]),
        ("5", None, ["NA"]),
    ]


def test_link_docs(spark, tmp_path):
    path = keyed(tmp_path, "l", "rsid", [
        ("1", {"linksets": [{"linksetdbs": [{"dbto": "omim", "links": ["9"]},
                                            {"dbto": "gene", "links": ["3", "4"]},
                                            {"dbto": "gene", "links": ["5"]}]}]}),
        ("2", {"linksets": []}), ("3", {"x": 1}), ("4", {"linksets": [{"ids": ["1"]}]}),
    ])
    assert rows(readers.read_link_docs(spark, path)) == [
        ("1", 0, "3"), ("1", 1, "4"), ("1", 2, "5"),
    ]


def test_gene_xml(spark, tmp_path):
    def record(*described):
        inner = "".join(
            "<Gene-ref>" + (f"<Gene-ref_desc>{d}</Gene-ref_desc>" if d else "") + "</Gene-ref>"
            for d in described
        )
        return f"<Set><E>{inner}</E></Set>"

    path = keyed(tmp_path, "x", "uid", [
        ("1", record(" non-protein thing ", "b")), ("2", record(None, "b")), ("3", "<Set/>"),
    ])
    assert rows(readers.read_gene_xml(spark, path)) == [
        ("1", "non-protein thing"), ("2", None), ("3", None),
    ]


def test_run_log(spark, tmp_path):
    root = str(tmp_path)
    board = spark.createDataFrame([("overall_score", 0.5), ("score_x", 0.25)], "key STRING, value DOUBLE")
    runs.log_run(spark, root, "e1", "r1", {"model": "m", "top_p": 1.0}, board, ["a.csv"])
    runs.log_run(spark, root, "e1", "r2", {"model": "n"}, {"overall_score": 0.75}, step=3)
    runs.log_run(spark, root, "e2", "r3", metrics={"overall_score": 1.0})
    runs.tag_run(spark, root, "e1", "r2", {"kind": "tools"})
    params = runs.read_run_table(spark, root, "run_params").select("run_id", "key", "value")
    assert rows(params) == [("r1", "model", "m"), ("r1", "top_p", "1.0"), ("r2", "model", "n")]
    scores = runs.read_run_table(spark, root, "run_metrics", "e1")
    assert rows(scores.select("run_id", "key", "step", "value")) == [
        ("r1", "overall_score", 0, 0.5), ("r1", "score_x", 0, 0.25), ("r2", "overall_score", 3, 0.75),
    ]
    tags = runs.read_run_table(spark, root, "run_tags")
    assert rows(runs.runs_with_tag(scores, tags, "kind", "tools").select("run_id")) == [("r2",)]
    assert runs.read_run_table(spark, root, "run_artifacts").first()["path"] == "a.csv"


@pytest.mark.parametrize("files", [1, 5])
def test_ids_run_on_over_files(spark, files):
    docs = spark.createDataFrame(
        [(f"f{i}", json.dumps({"t": {f"q{i}{j}": "a" for j in range(i + 1)}})) for i in range(files)],
        "path STRING, value STRING",
    ).repartition(3)
    got = rows(parsers.parse_nested_qa(docs).select("id", "question"), "id")
    questions = [f"q{i}{j}" for i in range(files) for j in range(i + 1)]
    assert got == list(enumerate(questions))


def test_repeated_keys_cost_no_search_of_all_entries(spark):
    """20,000 questions, each twice: the last answer counts, at the place of the first."""
    entries = [f'"q{i}": "{turn}{i}"' for turn in "ab" for i in range(20_000)]
    docs = spark.createDataFrame([("p", '{"t": {' + ", ".join(entries) + "}}")], "path STRING, value STRING")
    got = parsers.parse_nested_qa(docs).orderBy("id").collect()
    assert len(got) == 20_000
    assert [(r["question"], r["answers"]) for r in (got[0], got[-1])] == [("q0", ["b0"]), ("q19999", ["b19999"])]


def test_files_have_rows_or_rejects(spark, tmp_path):
    texts = ['{"T": {"q": "a"}}', "{}", " ", "[1]", '{"T": {"q": "b"', '{"T": {"q": "c"}, "X": [1], "Y": null, "Z": "s"}']
    for i, text in enumerate(texts):
        put(tmp_path / f"{i}.json", text)
    good, rejects = readers.read_benchmark(spark, str(tmp_path))
    assert rows(good, "id") == [(0, "T", "q", ["a"]), (1, "T", "q", ["c"])]
    bad = rejects.withColumn("path", F.substring_index("path", "/", -1)).collect()
    whole = "no object of tasks"
    assert sorted(map(tuple, bad), key=repr) == sorted(
        [
            ("2.json", None, whole, " "),
            ("3.json", None, whole, "[1]"),
            ("4.json", None, whole, texts[4]),
            *[("5.json", part, "another shape", None) for part in "XYZ"],
        ],
        key=repr,
    )


def test_lists_have_rows_or_rejects(spark, tmp_path):
    put(tmp_path / "1", '{"a": [{"type": "t", "body": "b", "ideal_answer": ["x"]}], "b": {"type": "t"}}')
    put(tmp_path / "2", "[]")
    good, rejects = readers.read_benchmark(spark, str(tmp_path), "list")
    assert rows(good) == [(0, "t", "b", "x", ["x"])]
    assert rows(rejects.select("part", "reason")) == [("b", "another shape"), (None, "no object of lists")]


def test_replies_have_rows_or_rejects(spark, tmp_path):
    path = keyed(tmp_path, "s", "term", [("a", {"esearchresult": {"idlist": []}}), ("b", "x"), ("c", {"e": 1}), ("d", None)])
    with open(path, "a") as lines:
        lines.write("\n{broken")
    good, rejects = readers.read_replies(spark, path, "search")
    assert rows(good) == []
    assert rows(rejects.select("key", "reason", "_corrupt_record")) == [
        ("b", "no JSON", "x"), ("c", "no list of ids", '{"e": 1}'), ("d", "no list of ids", "null"),
        (None, "no JSON line", "{broken"),
    ]
    texts = ["<Set><a/></Set>", "<Set><a></Set>", "text", " <Set>"]
    path = keyed(tmp_path, "x", "uid", [(str(i), x) for i, x in enumerate(texts)])
    good, rejects = readers.read_replies(spark, path, "gene_xml")
    assert rows(good) == [("0", None)]
    assert rows(rejects.select("key", "reason")) == [("1", "no XML"), ("2", "no XML"), ("3", "no XML")]
    empty = put(tmp_path / "none", "")
    assert [df.count() for df in readers.read_replies(spark, empty, "summary")] == [0, 0]


def test_ids_need_no_order_of_all_files(spark):
    docs = spark.range(40).select(
        F.format_string("f%03d", F.col("id")).alias("path"),
        F.concat(F.lit('{"t": {"q'), F.col("id").cast("string"), F.lit('": "a", "r": "b"}}')).alias("value"),
    )
    read = parsers.parse_nested_qa(docs.repartition(6))
    assert [r.question for r in read.orderBy("id").collect()][::2] == [f"q{i}" for i in range(40)]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # documents were parsed once, before


def test_repeated_logs_leave_rows_once(spark, tmp_path):
    root = str(tmp_path)
    for value in (0.1, 0.5, 0.5):
        runs.log_run(spark, root, "e", "r", {"m": 1}, {"s": value}, ["a"])
    runs.log_run(spark, root, "e", "r", metrics={"s": 0.75}, step=1)
    runs.log_run(spark, root, "e", "r2", metrics={"s": 0.25})
    runs.tag_run(spark, root, "e", "r", {"k": "old", "l": "x"})
    runs.tag_run(spark, root, "e", "r", {"k": "new"})
    metrics = runs.read_run_table(spark, root, "run_metrics").select("run_id", "key", "step", "value")
    assert rows(metrics) == [("r", "s", 0, 0.5), ("r", "s", 1, 0.75), ("r2", "s", 0, 0.25)]
    assert runs.read_run_table(spark, root, "run_params").count() == 1
    assert runs.read_run_table(spark, root, "run_artifacts").count() == 1
    tags = runs.read_run_table(spark, root, "run_tags").select("key", "value")
    assert rows(tags) == [("k", "new"), ("l", "x")]


def test_results_are_cut_into_files_of_bounded_rows(spark):
    path = scratch_path(spark, "bounded")
    row = "id, 'T' task, 'a\nb' question, 'x' answer, 'y' raw_prediction, 'y' processed_prediction, 0.5D score, true success"
    df = spark.range(25).selectExpr(*row.split(", ")).coalesce(1)
    writers.write_results(df, path, most_rows=10)
    read = readers.read_results(spark, path)
    assert len(read.inputFiles()) == 3
    assert rows(read, "id") == rows(df, "id")
