"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evalspark.functions import fixed, metrics, text, vectors
from evalspark.functions.parsing import Rule
from evalspark.operators import (
    answers,
    items,
    judging,
    lookups,
    pairing,
    projections,
    prompts,
    ranking,
    reports,
    routing,
    scoreboards,
    scoring,
    similarity,
    toolcalls,
)
from evalspark.operators.toolcalls import Tool
from evalspark.plans.tables import Tables, part_disease, question_text
from evalspark.session import scratch_path
from evalspark.sources import parsers, readers, runs, sums, writers
from evalspark.streaming import scoreboard as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(job: Callable[[Tables], DataFrame]):
    """Register a job over :class:`Tables` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(Tables(spark, sf_dir))

    run.__name__ = job.__name__
    run.__doc__ = job.__doc__
    QUERIES[job.__name__] = run
    return job


def _r6(column) -> Column:
    return F.round(column if isinstance(column, Column) else F.col(column), 6)


def _joined(column, separator: str = "|") -> Column:
    return F.array_join(column, separator)


REGISTRY = {
    "click": Tool(required=("k",)),
    "view": Tool(required=("k", "page")),
    "purchase": Tool(),
    "signup": Tool(optional=("k",)),
}
EVENT_RULES = (
    Rule("task", enum=("click", "view", "purchase", "signup")),
    Rule("question", min_length=1),
    Rule("answer", pattern="^[0-9]+$", min_length=3),
    Rule("explanation", required=False),
)


# === sources and sinks ======================================================================


def _blocks_of_items(t: Tables) -> DataFrame:
    """Nested documents of 100 genes each; name conversions have list answers."""
    gene_id = F.floor(F.col("id") / 10)
    quoted = F.concat(F.lit('"'), F.col("answer"), F.lit('"'))
    answer = F.when(
        F.col("id") % 10 == 2, F.concat(F.lit("["), quoted, F.lit(', "x"]'))
    ).otherwise(quoted)
    entry = F.concat(F.lit('"'), F.col("question"), F.lit('": '), answer)
    per_task = (
        t.items.select(
            F.floor(gene_id / 100).alias("block"),
            (F.col("id") % 10).alias("k"),
            "task",
            gene_id.alias("gene"),
            entry.alias("entry"),
        )
        .groupBy("block", "k", "task")
        .agg(_joined(ranking.ordered_values(F.col("gene"), F.col("entry")), ", ").alias("body"))
    )
    section = F.concat(F.lit('"'), F.col("task"), F.lit('": {'), F.col("body"), F.lit("}"))
    return per_task.groupBy("block").agg(
        F.concat(
            F.lit("{"),
            _joined(ranking.ordered_values(F.col("k"), section), ", "),
            F.lit("}"),
        ).alias("value")
    ).select(F.lpad(F.col("block").cast("string"), 12, "0").alias("path"), "value")


@query
def nested_benchmark_items(t: Tables) -> DataFrame:
    read = parsers.parse_nested_qa(_blocks_of_items(t))
    return read.select(
        "id", "task", "question", _joined("answers").alias("answers"), F.array_size("answers").alias("n")
    )


@query
def typed_question_items(t: Tables) -> DataFrame:
    ideal = F.when(F.col("uid") % 5 == 0, F.array().cast("array<string>")).otherwise(
        F.array("symbol", "ensembl")
    )
    entry = F.to_json(
        F.struct(
            F.col("gene_type").alias("type"),
            F.concat(F.lit("What is "), "symbol", F.lit("?")).alias("body"),
            ideal.alias("ideal_answer"),
        )
    )
    docs = (
        t.gene.select(F.floor(F.col("uid") / 100).alias("block"), "uid", entry.alias("entry"))
        .groupBy("block")
        .agg(_joined(ranking.ordered_values(F.col("uid"), F.col("entry")), ", ").alias("body"))
        .select(
            F.lpad(F.col("block").cast("string"), 12, "0").alias("path"),
            F.concat(F.lit('{"questions": ['), "body", F.lit("]}")).alias("value"),
        )
    )
    read = parsers.parse_question_list(docs)
    return read.select("id", "task", "question", "answer", _joined("answers").alias("answers"))


def _one_file_each(docs: DataFrame, name: str) -> str:
    """Documents (path, value) written as a file each; the folder's path."""
    folder = scratch_path(docs.sparkSession, name)
    docs.repartition("path").write.partitionBy("path").text(folder)
    return folder


def _block_of(path: str) -> Column:
    return F.regexp_extract(path, r"path=(\d+)", 1).cast("long")


@query
def nested_files_accounted(t: Tables) -> DataFrame:
    """Benchmark files read from disk, two in five broken: rows and rejects of all of them."""
    block = F.col("path").cast("long") % 5
    docs = _blocks_of_items(t).select(
        "path",
        F.when(block == 1, F.expr("substring(value, 1, length(value) - 1)"))
        .when(block == 2, F.concat(F.lit("["), "value", F.lit("]")))
        .when(block == 3, F.concat(F.lit('{"Broken": 5, '), F.expr("substring(value, 2)")))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    good, rejects = readers.read_benchmark(t.spark, _one_file_each(docs, "nested-files"))
    rows = good.select("id", "task", "question", _joined("answers").alias("answers"))
    bad = rejects.select(_block_of("path").alias("block"), "part", "reason")
    return rows.unionByName(bad, allowMissingColumns=True)


@query
def list_files_accounted(t: Tables) -> DataFrame:
    """Typed question files of 50 genes, one in three without a list: rows and rejects."""
    body = F.concat(F.lit("What is "), "symbol", F.lit("?"))
    entry = F.to_json(F.struct(F.col("gene_type").alias("type"), body.alias("body"), F.array("symbol").alias("ideal_answer")))
    block = F.floor(F.col("uid") / 50).alias("block")
    docs = (
        t.gene.select(block, "uid", entry.alias("entry"))
        .groupBy("block")
        .agg(_joined(ranking.ordered_values(F.col("uid"), F.col("entry")), ", ").alias("body"))
        .select(
            F.lpad(F.col("block").cast("string"), 12, "0").alias("path"),
            F.when(F.col("block") % 3 == 1, F.lit('{"questions": {"type": "none"}}'))
            .when(F.col("block") % 3 == 2, F.concat(F.lit('{"questions": ['), "body", F.lit("]}")))
            .otherwise(F.concat(F.lit('{"first": ['), "body", F.lit('], "more": []}')))
            .alias("value"),
        )
    )
    good, rejects = readers.read_benchmark(t.spark, _one_file_each(docs, "list-files"), "list")
    bad = rejects.select(_block_of("path").alias("block"), "part", "reason")
    return good.select("id", "task", "question", "answer").unionByName(bad, allowMissingColumns=True)


@query
def reply_files_accounted(t: Tables) -> DataFrame:
    """Stored replies of five kinds, read from lines: (kind, reason, replies, rows)."""
    uid, state = F.col("uid").cast("string"), F.col("uid") % 4
    record = F.concat(F.lit('{"result": {"uids": [], "'), uid, F.lit('": {"name": "x", "chr": "1"}}}'))
    kinds = {
        "search": ("term", F.concat(F.lit('{"esearchresult": {"idlist": ["'), uid, F.lit('"]}}')), '{"esearchresult": {}}'),
        "link": (
            "rsid",
            F.concat(F.lit('{"linksets": [{"linksetdbs": [{"dbto": "gene", "links": ["'), uid, F.lit('"]}]}]}')),
            '{"linksets": []}',
        ),
        "gene_xml": ("uid", F.lit("<S><Gene-ref><Gene-ref_desc>d</Gene-ref_desc></Gene-ref></S>"), "<S><E></S>"),
        "summary": (None, record, '{"result": []}'),
        "snp": (None, record, '{"header": {}}'),
    }
    parts = []
    for kind, (key, good_text, other_shape) in kinds.items():
        text = F.when(state == 1, F.lit(other_shape)).when(state == 2, F.lit("no reply")).otherwise(good_text)
        line = F.to_json(F.struct(uid.alias(key), text.alias("value"))) if key else text
        # Of lines that are cut off, only those with a key differ from other broken texts.
        line = F.when(state == 3, F.lit('{"cut')).otherwise(line)
        folder = scratch_path(t.spark, f"lines-{kind}")
        t.gene.select(line.alias("value")).write.text(folder)
        read, rejects = readers.read_replies(t.spark, folder, kind)
        none = F.lit(None).cast("string").alias("reason")
        parts.append(read.select(F.lit(kind).alias("kind"), none))
        parts.append(rejects.select(F.lit(kind).alias("kind"), "reason"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def predictions_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "predictions")
    out = t.preds.select(
        "id",
        "task",
        "question",
        F.coalesce("raw_prediction", F.lit("")).alias("answer"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit('said "'), "task", F.lit('"\n'))).alias(
            "explanation"
        ),
        "success",
    )
    writers.write_predictions(out, path)
    return readers.read_predictions(t.spark, path, multi_line=False)


@query
def paired_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "paired")
    pair = t.preds.select(
        "task",
        "question",
        F.when(F.col("raw_prediction").isNotNull(), F.array("raw_prediction")).alias("predicted"),
        F.when(F.col("id") % 10 == 2, F.array("answer", F.lit("x")))
        .otherwise(F.array("answer"))
        .alias("true"),
    )
    writers.write_paired(pair, path)
    read = readers.read_paired(t.spark, path, lines=True)
    return read.select(
        "task", "question", _joined("predicted").alias("predicted"), _joined("true").alias("gold")
    )


@query
def paired_documents_round_trip(t: Tables) -> DataFrame:
    """One nested document per benchmark (block of questions), read back as whole files."""
    folder = scratch_path(t.spark, "paired-documents")
    rows = t.preds.select(
        F.pmod("id", F.lit(7)).alias("benchmark"),
        "task",
        F.concat(F.lit('"'), "question", F.lit('"\n')).alias("question"),
        "raw_prediction",
        "answer",
    ).select(
        "benchmark", "task", "question",
        F.col("raw_prediction").alias("predicted"), F.array("answer", F.lit("x")).alias("true"),
    )
    writers.write_paired_documents(rows, folder)
    docs = readers.read_documents(t.spark, folder)
    named = F.regexp_extract("path", r"benchmark=(\d+)", 1).cast("long").alias("path")
    read = parsers.parse_paired(docs.select(named, "value"))
    return read.select(
        "task", "question", _joined("predicted").alias("predicted"), _joined("true").alias("gold")
    )


@query
def results_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "results")
    scored = scoring.score_answers(t.preds).select(
        "id", "task", F.concat("question", F.lit('\n"q", x')).alias("question"), "answer",
        "raw_prediction", "processed_prediction", "score", "success",
    )
    writers.write_results(scored, path)
    return readers.read_results(t.spark, path)


def _model_metrics(t: Tables) -> DataFrame:
    """One run per model: its scoreboard as run_metrics rows."""
    sums = scoreboards.score_cube(t.run_results, ["model", "task"])
    return sums.where("model IS NOT NULL").select(
        F.lit("events").alias("experiment"),
        F.concat(F.lit("model-"), F.col("model").cast("string")).alias("run_id"),
        F.coalesce(F.concat(F.lit("score_"), "task"), F.lit("overall_score")).alias("key"),
        F.lit(0).cast("long").alias("step"),
        F.col("score").alias("value"),
    )


@query
def run_log_metrics(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "runs")
    board = scoreboards.scoreboard(t.run_results)
    runs.log_run(
        t.spark, root, "events", "all",
        params={"model": "any", "max_tokens": 800},
        metrics=scoreboards.metrics_long(board),
        artifacts=["results.csv"],
    )
    logged = runs.read_run_table(t.spark, root, "run_metrics", "events")
    return logged.select("run_id", "key", "step", _r6("value").alias("value"))


@query
def repeated_run_log(t: Tables) -> DataFrame:
    """Metrics of every model logged, logged again, corrected, and continued with a step."""
    root = scratch_path(t.spark, "run-commits")
    rows = _model_metrics(t)
    wrong = rows.withColumn("value", F.lit(-1.0))
    later = rows.withColumns({"step": F.lit(1).cast("long"), "value": F.col("value") / 2})
    for commit, logged in (("0", wrong), ("0", rows), ("1", later), ("1", later)):
        runs.append_run_table(logged, root, "run_metrics", commit)
    read = runs.read_run_table(t.spark, root, "run_metrics", "events")
    return read.select("run_id", "key", "step", _r6("value").alias("value"))


@query
def metrics_of_tagged_runs(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "tags")
    metric_rows = _model_metrics(t)
    runs.append_run_table(metric_rows, root, "run_metrics")
    last = F.substring_index("run_id", "-", -1).cast("int")
    tags = runs.read_run_table(t.spark, root, "run_metrics").select(
        "experiment",
        "run_id",
        F.lit("parity").alias("key"),
        F.when(last % 2 == 0, "even").otherwise("odd").alias("value"),
    ).distinct()
    runs.append_run_table(tags, root, "run_tags")
    tagged = runs.runs_with_tag(
        runs.read_run_table(t.spark, root, "run_metrics"),
        runs.read_run_table(t.spark, root, "run_tags"),
        "parity",
        "even",
    )
    return tagged.select("run_id", "key", _r6("value").alias("value"))


@query
def search_reply_hits(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit('"'), F.col("uid").cast("string"), F.lit('"'))
    docs = t.gene_disease.groupBy("disease").agg(
        F.concat(
            F.lit('{"header": {}, "esearchresult": {"count": "9", "idlist": ['),
            _joined(ranking.ordered_values(F.col("rnk"), quoted), ","),
            F.lit("]}}"),
        ).alias("value")
    )
    return parsers.parse_search_docs(docs.withColumnRenamed("disease", "term"), 10)


@query
def summary_reply_records(t: Tables) -> DataFrame:
    key = F.col("uid").cast("string")
    record = F.to_json(
        F.struct(
            key.alias("uid"),
            F.col("symbol").alias("name"),
            "chromosome",
            F.col("symbol").alias("nomenclaturesymbol"),
            F.col("ensembl").alias("nomenclaturename"),
            F.col("gene_type").alias("description"),
            F.struct(F.lit("Homo sapiens").alias("scientificname")).alias("organism"),
            "summary",
        )
    )
    docs = t.gene.select(
        F.concat(
            F.lit('{"result": {"uids": ["'), key, F.lit('"], "'), key, F.lit('": '), record, F.lit("}}")
        ).alias("value")
    )
    return parsers.parse_summary_docs(docs)


@query
def snp_reply_records(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    name = F.concat(F.lit('{"name": "G'), F.col("o_custkey").cast("string"), F.lit('"}'))
    kind = F.col("o_orderkey") % 4
    genes = (
        F.when(kind == 0, F.concat(F.lit(', "genes": '), name))
        .when(kind == 1, F.concat(F.lit(', "genes": ['), name, F.lit(', {"name": "H"}]')))
        .when(kind == 2, F.concat(F.lit(', "genes": ['), name, F.lit(', {"id": 1}]')))
        .otherwise(F.lit(""))
    )
    docs = t.read("orders").select(
        F.concat(
            F.lit('{"result": {"uids": ["'), key, F.lit('"], "'), key, F.lit('": {"chr": "'),
            (F.col("o_custkey") % 22 + 1).cast("string"), F.lit('"'), genes, F.lit("}}}"),
        ).alias("value")
    )
    return parsers.parse_snp_docs(docs).select(
        "rsid", "chr", _joined("genes", ", ").alias("genes")
    )


@query
def link_reply_genes(t: Tables) -> DataFrame:
    customer = F.col("o_custkey").cast("string")
    docs = t.read("orders").select(
        F.col("o_orderkey").cast("string").alias("rsid"),
        F.when(F.col("o_orderkey") % 7 == 3, F.lit('{"linksets": []}'))
        .when(F.col("o_orderkey") % 7 == 5, F.lit('{"error": "none"}'))
        .otherwise(
            F.concat(
                F.lit('{"linksets": [{"linksetdbs": [{"dbto": "omim", "links": ["1"]}, '),
                F.lit('{"dbto": "gene", "links": ["'), customer, F.lit('"]}, '),
                F.lit('{"dbto": "gene", "links": ["5", "'), customer, F.lit('7"]}]}]}'),
            )
        )
        .alias("value"),
    )
    return parsers.parse_link_docs(docs)


@query
def gene_xml_types(t: Tables) -> DataFrame:
    described = F.when(F.col("uid") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<Gene-ref_desc> "), "gene_type", F.lit(" </Gene-ref_desc>"))
    )
    docs = t.gene.select(
        "uid",
        F.concat(
            F.lit("<Set><Entry><Gene-ref><Gene-ref_locus>"), "symbol",
            F.lit("</Gene-ref_locus>"), described,
            F.lit("</Gene-ref><Gene-ref><Gene-ref_desc>other</Gene-ref_desc></Gene-ref></Entry></Set>"),
        ).alias("value"),
    )
    return parsers.parse_gene_xml(docs)


# === projections, filters, samples ========================================================


@query
def item_table(t: Tables) -> DataFrame:
    return items.item_view(t.items)


@query
def sampled_items(t: Tables) -> DataFrame:
    """50 items, the same for the same seed (the sampling operator)."""
    return items.item_view(items.sample_items(t.items, 50, seed=7))


@query
def first_items(t: Tables) -> DataFrame:
    """First 50 items by id (the limit operator)."""
    return items.item_view(items.limit_items(t.items, 50))


@query
def valid_score_rows(t: Tables) -> DataFrame:
    gaps = t.run_results.withColumn(
        "score",
        F.when(F.col("id") % 10 == 3, F.lit(float("nan")))
        .when(F.col("task") != "error", F.col("score")),
    )
    return items.valid_scores(gaps).select("id", "task", _r6("score").alias("score"))


@query
def question_keys(t: Tables) -> DataFrame:
    return items.with_question_key(t.questions).select("id", "question_key")


@query
def flat_answers(t: Tables) -> DataFrame:
    return items.flatten_answers(t.part_gold).select("disease", "answer")


@query
def list_literals(t: Tables) -> DataFrame:
    listed = t.items.select(
        "id",
        F.when(F.col("id") % 10 == 2, F.concat(F.lit("['"), "answer", F.lit("', 'b c']")))
        .when(F.col("id") % 10 == 3, F.concat(F.lit("[broken "), "answer", F.lit("]")))
        .otherwise(F.col("answer"))
        .alias("answer"),
    )
    parsed = items.parse_list_literals(listed)
    return parsed.select("id", F.array_size("answers").alias("n"), _joined("answers").alias("answers"))


@query
def benchmark_rows(t: Tables) -> DataFrame:
    return items.benchmark_view(t.items).select(
        "id", "task", "question_key", "answer", F.array_size("answers").alias("n")
    )


@query
def model_backends(t: Tables) -> DataFrame:
    named = t.run_results.select(
        "id",
        F.when(F.col("model") == 0, fixed.LOCAL_MODELS[0])
        .when(F.col("model") == 1, fixed.LOCAL_MODELS[1])
        .otherwise(F.concat(F.lit("hosted-"), F.col("model").cast("string")))
        .alias("model"),
    )
    return items.route_model(named)


@query
def distinct_answer_labels(t: Tables) -> DataFrame:
    repeated = t.preds.select(
        "id", F.array("task", "answer", "task", F.lower("answer"), "answer").alias("answers")
    )
    return items.distinct_labels(repeated).select(
        "id", F.array_size("answers").alias("n"), _joined("answers").alias("answers")
    )


@query
def shared_answer_labels(t: Tables) -> DataFrame:
    return items.shared_labels(
        t.preds.select("task", F.col("raw_prediction").alias("label")),
        t.items.select("task", F.col("answer").alias("label")),
    )


# === prompts ================================================================================


def _example_rows(t: Tables) -> DataFrame:
    """Two turns for each of the first four items of every task."""
    chosen = ranking.top_candidates(t.items, 4, ["task"], "id")
    turn = F.struct(F.lit(0).alias("part"), F.lit("user").alias("role"), F.col("question").alias("content"))
    reply = F.struct(F.lit(1).alias("part"), F.lit("assistant").alias("role"), F.col("answer").alias("content"))
    return chosen.select("task", "id", F.inline(F.array(turn, reply))).select(
        "task", (F.floor(F.col("id") / 10) * 2 + F.col("part")).alias("pos"), "role", "content"
    )


def _message_text(column) -> Column:
    return _joined(
        F.transform(column, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), " / "
    )


@query
def few_shot_sets(t: Tables) -> DataFrame:
    sets = prompts.few_shot_array(_example_rows(t), "task")
    return sets.select("task", _message_text("examples").alias("examples"))


@query
def few_shot_messages(t: Tables) -> DataFrame:
    sets = prompts.few_shot_array(_example_rows(t), "task")
    built = prompts.build_messages(t.items, "You answer briefly.", sets, "task")
    return built.select("id", _message_text("messages").alias("messages"))


@query
def literal_shot_messages(t: Tables) -> DataFrame:
    shots = [("user", "Convert ENSG1 to official gene symbol."), ("assistant", "GENE1")]
    built = prompts.build_messages(t.items, "You answer briefly.", shots)
    return built.select("id", _message_text("messages").alias("messages"))


@query
def structured_prompts(t: Tables) -> DataFrame:
    return prompts.structured_prompt(t.items).select("id", "prompt")


@query
def appended_turns(t: Tables) -> DataFrame:
    history = t.read("conversations")
    asked = history.where("turn = 0").select(
        "conv_id",
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"),
                         F.lit('[{"name": "search"}]').alias("text")),
                F.struct(F.lit(1).cast("long").alias("turn"), F.lit("tool").alias("role"),
                         F.concat(F.lit("result for "), F.col("conv_id").cast("string")).alias("text")),
            )
        ),
    )
    return prompts.append_turns(history, asked)


@query
def tool_message_lists(t: Tables) -> DataFrame:
    """Conversations with calls and replies as nested lists, and back to a row per message."""
    calls = F.when(
        (F.col("role") == "assistant") & (F.col("turn") % 4 == 1),
        F.array(
            F.struct(F.lit("search").alias("name"), F.concat(F.lit('{"k": '), F.col("turn").cast("string"), F.lit("}")).alias("arguments")),
            F.struct(F.lit("open").alias("name"), F.lit("{}").alias("arguments")),
        ),
    )
    none = F.lit(None).cast("struct<turn:bigint,place:int>")
    turns = t.read("conversations").select(
        "conv_id", (F.col("turn") * 3).cast("long").alias("turn"), "role", "text", calls.alias("calls"), none.alias("reply_to")
    )
    replies = turns.where("calls IS NOT NULL").select(
        "conv_id", "turn", F.posexplode("calls").alias("place", "call")
    ).select(
        "conv_id",
        (F.col("turn") + F.col("place") + 1).alias("turn"),
        F.lit("tool").alias("role"),
        F.concat(F.lit("result of "), "call.name").alias("text"),
        F.lit(None).cast(turns.schema["calls"].dataType).alias("calls"),
        F.struct("turn", "place").alias("reply_to"),
    )
    lists = prompts.message_lists(turns.unionByName(replies), block_turns=8)
    back = prompts.message_rows(lists)
    return back.select(
        "conv_id", "turn", "role", "text",
        F.array_join(F.transform("calls", lambda c: F.concat(c["name"], c["arguments"])), "|").alias("calls"),
        F.col("reply_to.turn").alias("reply_turn"), F.col("reply_to.place").alias("reply_place"),
    )


@query
def tool_result_turns(t: Tables) -> DataFrame:
    calls = toolcalls.extract_tool_calls(t.tool_text).where("parameters_ok")
    done = calls.withColumn("result", F.concat(F.lit("r"), F.col("id").cast("string")))
    return prompts.tool_result_turns(done)


@query
def judge_prompts(t: Tables) -> DataFrame:
    candidates = t.preds.select("id", F.col("raw_prediction").alias("candidate"))
    return prompts.judge_prompt(t.items, candidates, "Correctness of the answer.").select(
        "id", "prompt"
    )


@query
def pairwise_prompts(t: Tables) -> DataFrame:
    both = t.preds.select(
        "id",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("model"), F.col("answer")),
                F.struct(F.lit(1).alias("model"), F.col("raw_prediction").alias("answer")),
                F.struct(F.lit(2).alias("model"), F.lit("unused").alias("answer")),
            )
        ),
    )
    return prompts.pairwise_prompt(both, 0, 1, "accuracy", t.items)


# === collecting and parsing answers ============================================================


def _length_reply(row: dict) -> str:
    """Stand-in for a model: fails for some ids, answers with the question's length."""
    if row["id"] % 7 == 3:
        raise ValueError("no reply")
    return "chr" + str(len(row["question"]))


def _text_reply(row: dict) -> str:
    if row["alias"].endswith("e"):
        raise TimeoutError("slow")
    return row["alias"].upper()


@query
def batch_answers(t: Tables) -> DataFrame:
    asked = answers.batch_answer(items.item_view(t.items), _length_reply, max_attempts=2)
    return asked.select("id", "raw_prediction", "success", "attempts", "error")


@query
def distinct_call_answers(t: Tables) -> DataFrame:
    names = t.read("part").select("p_partkey", F.col("p_name").alias("alias"))
    return answers.distinct_calls(names, ["alias"], _text_reply, max_attempts=3)


@query
def structured_answers(t: Tables) -> DataFrame:
    parsed = answers.parse_structured(t.structured_raw)
    return parsed.select("id", "task", "question", "answer", "explanation", "success")


@query
def structured_success_by_task(t: Tables) -> DataFrame:
    """Rejected answers count for the task of their item."""
    asked = t.structured_raw.join(
        t.read("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("task")), "id"
    )
    return (
        answers.parse_structured(asked)
        .groupBy("task")
        .agg(
            F.count("*").alias("answers"),
            F.count_if(~F.col("success")).alias("failures"),
            _r6(F.avg(F.col("success").cast("int"))).alias("success_rate"),
        )
    )


@query
def structured_rejects(t: Tables) -> DataFrame:
    parsed = answers.parse_structured(t.structured_raw)
    return answers.rejected(parsed).select("id", "raw", _joined("violations").alias("violations"))


@query
def schema_violations(t: Tables) -> DataFrame:
    return answers.check_schema(t.structured_raw, EVENT_RULES)


@query
def first_valid_attempts(t: Tables) -> DataFrame:
    tries = t.read("events").select(
        (F.col("event_id") - F.col("event_id") % 3).alias("id"),
        (F.col("event_id") % 3 + 1).alias("attempt"),
        F.concat("event_type", F.col("user_id").cast("string")).alias("answer"),
        F.col("event_type").isin("click", "signup").alias("valid"),
    )
    return answers.first_valid_attempt(tries, max_attempts=2)


@query
def reasoning_split(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 3
    raw = (
        F.when(kind == 0, F.concat(F.lit("<think>\nuser "), F.col("user_id").cast("string"),
                                   F.lit("\nasks </think>\n\n"), F.col("event_type")))
        .when(kind == 1, F.concat(F.lit("late</think> "), F.col("event_type")))
        .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" \n")))
    )
    texts = t.read("events").select(F.col("event_id").alias("id"), raw.alias("raw"))
    return answers.split_reasoning(texts).select("id", "thoughts", "answer")


@query
def unfenced_texts(t: Tables) -> DataFrame:
    return answers.strip_fence(t.tool_text)


@query
def fenced_structured_answers(t: Tables) -> DataFrame:
    """Reasoning, fence and JSON in one text, parsed in one pass."""
    wrapped = t.structured_raw.withColumn(
        "raw", F.concat(F.lit("<think>so</think>\n```json\n"), "raw", F.lit("\n```"))
    )
    return answers.parse_answers(wrapped).select("id", "thoughts", "task", "answer", "success")


@query
def tool_calls(t: Tables) -> DataFrame:
    calls = toolcalls.extract_tool_calls(t.tool_text)
    return calls.select(
        "id", "pos", "name", "parameters_ok",
        F.try_element_at("parameters", F.lit("k")).alias("k"),
        F.try_element_at("parameters", F.lit("page")).alias("page"),
    )


@query
def direct_answers(t: Tables) -> DataFrame:
    return toolcalls.direct_answers(t.tool_text)


@query
def unknown_tool_calls(t: Tables) -> DataFrame:
    calls = toolcalls.extract_tool_calls(t.tool_text)
    return toolcalls.unknown_tools(calls, REGISTRY).select("id", "pos", "name")


@query
def bad_tool_arguments(t: Tables) -> DataFrame:
    calls = toolcalls.extract_tool_calls(t.tool_text)
    return toolcalls.bad_arguments(calls, REGISTRY).select(
        "id", "pos", "name", "error",
        _joined(F.array_sort("missing")).alias("missing"),
        _joined(F.array_sort("extra")).alias("extra"),
    )


@query
def tool_usage(t: Tables) -> DataFrame:
    calls = toolcalls.extract_tool_calls(t.tool_text)
    usage = toolcalls.tool_usage(calls, REGISTRY)
    return usage.withColumn("error_share", _r6("error_share"))


@query
def final_answers(t: Tables) -> DataFrame:
    return toolcalls.final_answer(t.read("conversations"))


@query
def final_answers_in_five_turns(t: Tables) -> DataFrame:
    return toolcalls.final_answer(t.read("conversations"), fixed.MAX_TURNS_TEXT)


# === reports ===================================================================================


def _report_query(name: str, *columns: str, mode: str = "as_documented") -> None:
    def job(t: Tables) -> DataFrame:
        return reports.parse_reports(t.reports, mode=mode).select("query_id", *columns)

    job.__name__ = name
    job.__doc__ = f"Report fields {', '.join(columns)} ({mode})."
    query(job)


_report_query("report_request_ids", "request_id")
_report_query("report_statuses", "status")
_report_query("report_regions", "region")
_report_query("report_regions_as_coded", "region", mode="as_coded")
_report_query("report_first_hits", "first_hit")
_report_query("report_organisms", "organism", "organism_name")
_report_query("report_genes", "gene")


# === routing and lookups ==========================================================================


@query
def question_kinds(t: Tables) -> DataFrame:
    return routing.route_questions(t.questions).select("id", "kind")


@query
def question_arguments(t: Tables) -> DataFrame:
    return routing.route_questions(t.questions).select("id", "arg")


@query
def question_kinds_as_coded(t: Tables) -> DataFrame:
    return routing.route_questions(t.questions, "as_coded").select("id", "kind", "arg")


@query
def single_hop_kinds(t: Tables) -> DataFrame:
    routed = routing.route_questions(t.questions, kinds=fixed.SINGLE_HOP_KINDS)
    return routed.groupBy("kind").agg(F.count(F.lit(1)).alias("questions"))


def _lookup_query(name: str, kind: str, job) -> None:
    def run(t: Tables) -> DataFrame:
        asked = t.questions.where(F.col("task") == kind).select(
            "id", F.col("arg_true").alias("arg")
        )
        return job(asked, t.knowledge)

    run.__name__ = name
    run.__doc__ = f"Every {kind} question answered from the knowledge tables."
    query(run)


_lookup_query("alias_symbols", "alias", lookups.alias_to_symbol)
_lookup_query("disease_gene_names", "disease_genes", lookups.disease_to_genes)
_lookup_query("gene_chromosomes", "gene_chr", lookups.gene_to_chromosome)
_lookup_query("identifier_symbols", "ensembl", lookups.identifier_to_symbol)
_lookup_query("snp_gene_names", "snp_gene", lookups.snp_to_genes)
_lookup_query("snp_chromosomes", "snp_chr", lookups.snp_to_chromosome)
_lookup_query("protein_coding_flags", "coding", lookups.is_protein_coding)
_lookup_query("sequence_regions", "align", lookups.sequence_to_region)
_lookup_query("sequence_organisms", "organism", lookups.sequence_to_organism)
_lookup_query("sequence_aliases", "seq_alias", lookups.sequence_to_alias)
_lookup_query("disease_locations", "disease_loc", lookups.disease_to_locations)
_lookup_query("snp_functions", "snp_fn", lookups.snp_to_function)


@query
def snp_gene_rows(t: Tables) -> DataFrame:
    return lookups.snp_gene_rows(t.knowledge)


@query
def all_lookup_answers(t: Tables) -> DataFrame:
    answered = lookups.answer_by_lookup(t.questions, t.knowledge)
    return answered.select("id", "task", "kind", "predicted", "status")


@query
def lookup_scoreboard(t: Tables) -> DataFrame:
    """Questions of all twelve kinds answered by lookup, scored, on a scoreboard."""
    answered = lookups.answer_by_lookup(t.gold_questions, t.knowledge)
    scored = scoring.score_answers(
        answered.select(
            "id", "task", F.col("true").alias("answer"), F.col("predicted").alias("raw_prediction")
        ),
        distances=True,
    )
    by_task = scoreboards.board_sums(scored, ["task"]).rollup("task").agg(
        F.grouping("task").cast("int").alias("is_total"),
        *[F.sum(c).alias(c) for c in ("items", "successes", "score_sum", "scored", "distance_sum", "distances")],
    )
    return by_task.select(
        "task",
        "is_total",
        "items",
        _r6(F.col("successes") / F.col("items")).alias("success_rate"),
        _r6("score_sum").alias("score_sum"),
        _r6(F.col("score_sum") / F.col("scored")).alias("score"),
        _r6(F.col("distance_sum") / F.col("distances")).alias("edit_distance"),
    )


@query
def listed_lookup_pairs(t: Tables) -> DataFrame:
    """Answers as lists, written as nested pairs and read back; other kinds give lists of one."""
    kinds = ("disease_loc", "gene_chr")
    answered = lookups.answer_by_lookup(t.questions, t.knowledge, kinds=kinds, typed=True)
    pairs = answered.where(F.col("kind").isin(*kinds)).select(
        "task",
        F.concat_ws(" ", F.col("id").cast("string"), "question").alias("question"),
        F.col("answers").alias("predicted"),
        F.array(F.lit("x")).alias("true"),
    )
    folder = scratch_path(t.spark, "listed")
    writers.write_paired(pairs, folder)
    read = readers.read_paired(t.spark, folder, lines=True)
    return read.select(
        F.substring_index("question", " ", 1).cast("long").alias("id"),
        "task",
        _joined("predicted").alias("answers"),
        F.array_size("predicted").alias("n"),
    )


# === normalisation and scoring ==================================================================


@query
def normalised_answers(t: Tables) -> DataFrame:
    done = scoring.normalise_answers(t.mixed_answers)
    return done.select(
        "id", "task", F.array_size("normalised").alias("n"), _joined("normalised").alias("normalised")
    )


def _metric_query(name: str, source: str, metric, listed: bool) -> None:
    def run(t: Tables) -> DataFrame:
        rows = getattr(t, source)
        sides = [F.col("raw_prediction"), F.col("answer")]
        if listed:
            sides = [metrics.listed_answer(s) for s in sides]
        return rows.select("id", _r6(metric(*sides)).alias("score"))

    run.__name__ = name
    run.__doc__ = f"One metric over all of {source}."
    query(run)


_metric_query("exact_matches", "preds", metrics.exact_match, False)
_metric_query("set_recalls", "mixed_answers", metrics.set_recall, True)
_metric_query("character_recalls", "preds", metrics.character_recall, False)
_metric_query("region_matches", "regions", metrics.region_match, False)


@query
def location_set_recalls(t: Tables) -> DataFrame:
    """Disease locations scored as sets through the metric registry."""
    rows = t.mixed_answers.where(F.col("task") == fixed.TASK_DISEASE_LOCATION)
    return scoring.score_answers(rows).select("id", _r6("score").alias("score"))


def _scored_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "id", "task", "processed_prediction", _r6("score").alias("score"), "success", "status"
    )


@query
def task_scores(t: Tables) -> DataFrame:
    return _scored_columns(scoring.score_answers(t.mixed_answers))


@query
def task_scores_as_coded(t: Tables) -> DataFrame:
    return _scored_columns(scoring.score_answers(t.mixed_answers, "as_coded"))


@query
def item_scores(t: Tables) -> DataFrame:
    scored = scoring.score_on_success(scoring.score_answers(t.preds))
    return scored.select("id", "raw_prediction", "score", "score_on_success", "success")


@query
def edit_distances(t: Tables) -> DataFrame:
    done = scoring.edit_distances(t.preds)
    return done.select("id", "edit_distance")


@query
def fuzzy_ratios(t: Tables) -> DataFrame:
    done = scoring.edit_distances(t.preds)
    return done.select("id", _r6("fuzzy_ratio").alias("fuzzy_ratio"))



@query
def pooled_vectors(t: Tables) -> DataFrame:
    pooled = t.tokens.select("id", F.posexplode(vectors.mean_pool(F.col("tokens"), F.col("mask"))))
    return pooled.select("id", F.col("pos").alias("dim"), _r6("col").alias("value"))


@query
def pooled_vectors_from_rows(t: Tables) -> DataFrame:
    long = t.tokens.select("id", F.posexplode(F.arrays_zip("tokens", "mask"))).select(
        "id", F.col("col.mask").alias("m"), F.posexplode("col.tokens").alias("dim", "value")
    )
    pooled = similarity.mean_pool_long(long)
    return pooled.select("id", "dim", _r6("value").alias("value"))


@query
def unit_vectors(t: Tables) -> DataFrame:
    unit = similarity.l2_normalise(t.vectors).select("id", F.posexplode("vector"))
    return unit.select("id", F.col("pos").alias("dim"), _r6("col").alias("value"))


@query
def sentence_similarities(t: Tables) -> DataFrame:
    """Pooled and normalised sentence vectors compared with their neighbour's."""
    pooled = similarity.mean_pool(t.tokens)
    gold = pooled.select((F.col("id") - 1).alias("id"), "vector")
    similar = similarity.embedding_similarity(pooled, gold)
    return similar.select("id", _r6("cosine_similarity").alias("cosine_similarity"))


@query
def cosine_pairs(t: Tables) -> DataFrame:
    similar = similarity.embedding_similarity(t.vectors, t.next_vectors)
    return similar.select("id", _r6("cosine_similarity").alias("cosine_similarity"))


@query
def mean_cosine(t: Tables) -> DataFrame:
    similar = similarity.embedding_similarity(t.vectors, t.next_vectors)
    return similarity.mean_cosine(similar).withColumn("mean_cosine", _r6("mean_cosine"))


@query
def similarity_report(t: Tables) -> DataFrame:
    """Vectors against those after them; some questions have two gold answers or none."""
    pred = t.vectors.select(
        F.concat(F.lit("Question "), F.col("id").cast("string"), F.lit("?")).alias("question"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("predicted_answer"),
        "vector",
    )
    nth = F.explode(F.when(F.col("id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    gold = t.next_vectors.where("id % 3 <> 0").select("*", nth.alias("nth")).select(
        F.concat(F.lit(" Question "), F.col("id").cast("string"), F.lit("? ")).alias("question"),
        F.concat(F.lit("gold "), F.col("nth").cast("string")).alias("gold_answer"),
        "vector",
    )
    report = similarity.similarity_report(pred, gold)
    return report.withColumn("cosine_similarity", _r6("cosine_similarity"))


@query
def scores_with_context(t: Tables) -> DataFrame:
    """Task score, edit distance, fuzzy ratio and cosine of the same rows."""
    pairs = t.vectors.withColumnRenamed("vector", "pred_vector").join(
        t.next_vectors.withColumnRenamed("vector", "gold_vector"), "id", "left"
    )
    rows = t.preds.withColumn("vec", F.floor(F.col("id") / 10)).join(
        pairs.withColumnRenamed("id", "vec"), "vec", "left"
    )
    done = scoring.score_with_context(rows)
    return done.select(
        "id", "score", "edit_distance",
        _r6("fuzzy_ratio").alias("fuzzy_ratio"),
        _r6("cosine_similarity").alias("cosine_similarity"),
    )


@query
def nearest_vectors(t: Tables) -> DataFrame:
    """Mean vector of every label retrieves its five nearest stored vectors."""
    centres = (
        t.vectors.select("label", F.posexplode("vector"))
        .groupBy("label", "pos")
        .agg(F.avg("col").alias("x"))
        .groupBy("label")
        .agg(ranking.ordered_values(F.col("pos"), F.col("x")).alias("vector"))
        .withColumnRenamed("label", "query_id")
    )
    docs = t.vectors.select(F.col("id").alias("doc_id"), "vector")
    found = similarity.retrieve_top_k(centres, docs, k=5)
    return found.select("query_id", "doc_id", "place", _r6("similarity").alias("similarity"))


@query
def index_recall(t: Tables) -> DataFrame:
    """Every hundredth vector against all by the index and exactly: is 0.9 of the ten found?"""
    docs = t.vectors.select(F.col("id").alias("doc_id"), "vector")
    queries = docs.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id")
    found = projections.retrieve_by_index(queries, docs, k=10)
    measured = projections.recall(found, similarity.retrieve_top_k(queries, docs, k=10))
    return measured.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("reached"))


# === pairing ==================================================================================


@query
def pairs_by_id(t: Tables) -> DataFrame:
    paired = pairing.pair_by_id(t.preds.select("id", "raw_prediction"), t.items)
    return paired.select("id", "raw_prediction", "gold_answer")


def _disease_predictions(t: Tables) -> DataFrame:
    """One answer per part to the question about its disease; some ask differently."""
    asked = question_text("disease_genes", part_disease())
    return t.read("part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 10 == 0, F.concat(asked, F.lit(" Really?")))
        .when(
            F.col("p_partkey") % 10 == 1,
            F.concat(F.lit(" "), asked, F.lit(" "), F.lit(fixed.DECOMPOSE_SUFFIX)),
        )
        .otherwise(asked)
        .alias("question"),
        F.concat(F.lit("GENE"), F.col("p_partkey").cast("string")).alias("predicted_answer"),
    )


def _disease_gold(t: Tables) -> DataFrame:
    return t.part_gold.select(
        question_text("disease_genes", F.col("disease")).alias("question"), "answers"
    )


@query
def pairs_by_question(t: Tables) -> DataFrame:
    paired = pairing.pair_by_question(_disease_predictions(t), _disease_gold(t))
    return paired.select("id", "question_key", "predicted_answer", "gold_answer", "note")


@query
def unmatched_predictions(t: Tables) -> DataFrame:
    return pairing.unmatched(_disease_predictions(t), _disease_gold(t)).select(
        "id", "question_key", "predicted_answer", "gold_answer", "score", "note"
    )


@query
def best_gold_scores(t: Tables) -> DataFrame:
    paired = pairing.pair_by_question(_disease_predictions(t), _disease_gold(t))
    scored = paired.withColumn(
        "score", metrics.fuzzy_ratio(F.col("predicted_answer"), F.col("gold_answer"))
    )
    return pairing.best_gold(scored).select(
        "id",
        _r6("best_score").alias("best_score"),
        _r6("mean_score").alias("mean_score"),
        "gold_answers",
    )


# === aggregations ===============================================================================


def _rounded_board(board: DataFrame) -> DataFrame:
    return board.select(
        "task", "is_total", "items",
        _r6("success_rate").alias("success_rate"),
        _r6("score_sum").alias("score_sum"),
        _r6("score").alias("score"),
    )


@query
def scoreboard(t: Tables) -> DataFrame:
    return _rounded_board(scoreboards.scoreboard(scoring.score_answers(t.preds)))


@query
def folded_scoreboard(t: Tables) -> DataFrame:
    """Results folded into a board in three batches, one of them twice, with a base between."""
    root = scratch_path(t.spark, "folded")
    scored = t.run_results.withColumn("batch", F.pmod("id", F.lit(3)))
    for batch in (0, 1, 1):
        scoreboards.fold_results(scored.where(F.col("batch") == batch), root, batch)
    sums.compact(t.spark, root, ["task"])
    scoreboards.fold_results(scored.where("batch = 2"), root, 2)
    return _rounded_board(scoreboards.folded_scoreboard(t.spark, root))


@query
def ordered_scoreboard(t: Tables) -> DataFrame:
    board = scoreboards.scoreboard(scoring.score_answers(t.mixed_answers))
    return _rounded_board(scoreboards.order_results(board))


@query
def success_rate(t: Tables) -> DataFrame:
    done = scoreboards.success_rate(scoring.score_answers(t.mixed_answers))
    return done.select(_r6("success_rate").alias("success_rate"))


@query
def overall_score(t: Tables) -> DataFrame:
    done = scoreboards.overall_score(scoring.score_answers(t.mixed_answers))
    return done.select(_r6("overall_score").alias("overall_score"))


@query
def score_by_task(t: Tables) -> DataFrame:
    done = scoreboards.score_by_task(scoring.score_answers(t.mixed_answers))
    return done.select("task", _r6("score").alias("score"))


@query
def edit_distance_by_task(t: Tables) -> DataFrame:
    measured = scoring.score_with_context(t.preds)
    done = scoreboards.edit_distance_by_task(measured)
    return done.withColumn("edit_distance", _r6("edit_distance"))


@query
def metrics_long(t: Tables) -> DataFrame:
    board = scoreboards.scoreboard(scoring.score_answers(t.preds))
    return scoreboards.metrics_long(board).select("key", _r6("value").alias("value"))


@query
def chart_table(t: Tables) -> DataFrame:
    done = scoreboards.chart_table(t.run_results)
    return done.select(
        "task", _r6("score").alias("score"), _r6("overall_score").alias("overall_score")
    )


@query
def model_comparison(t: Tables) -> DataFrame:
    done = scoreboards.compare_models(t.run_results, [0, 1, 2, 3, 4])
    return done.select("task", *[_r6(c).alias(c) for c in done.columns if c != "task"])


@query
def tool_gain_by_benchmark(t: Tables) -> DataFrame:
    """What tools add per benchmark and task: models from 3 on have tools."""
    results = t.run_results.withColumns(
        {"tools": F.col("model") >= 3, "benchmark": F.when(F.col("id") % 3 == 0, "multi").otherwise("single")}
    )
    done = scoreboards.compare_runs(results, "tools", [False, True], ["benchmark", "task"])
    return done.select(
        "benchmark", "task", _r6("score_False").alias("without_tools"), _r6("score_True").alias("with_tools"),
        _r6("difference").alias("difference"),
    )


@query
def model_cube(t: Tables) -> DataFrame:
    done = scoreboards.score_cube(t.run_results, ["model", "task"])
    return done.select("model", "task", "margin", "items", _r6("score").alias("score"))


@query
def item_coverage(t: Tables) -> DataFrame:
    done = scoreboards.coverage(t.items, t.preds.where("success"))
    return done.select("task", "is_total", "items", "answered", _r6("coverage").alias("coverage"))


@query
def threshold_bands(t: Tables) -> DataFrame:
    """Points of each model: its share of successes as coverage, of high scores as match."""
    rates = t.run_results.groupBy("model", "task").agg(
        F.avg(F.col("success").cast("int")).alias("coverage"),
        F.avg((F.col("score") >= 0.9).cast("int")).alias("exact_match"),
    )
    done = scoreboards.threshold_band(rates)
    return done.select(
        "model", "task", _r6("coverage").alias("coverage"),
        _r6("exact_match").alias("exact_match"), "points",
    )


@query
def band_points_by_scheme(t: Tables) -> DataFrame:
    """Points by a table of bands: models with even numbers have the scheme of single hops."""
    rates = t.run_results.groupBy("model", "task").agg(
        F.avg(F.col("success").cast("int")).alias("coverage"),
        F.avg((F.col("score") >= 0.9).cast("int")).alias("exact_match"),
    )
    scheme = F.when(F.col("model") % 2 == 0, "single").when(F.col("model") == 1, "multi")
    rows = [("single", 2, 0.75, None, 0.05), ("single", 3, 0.9, None, None), ("single", 9, None, 1.0, 0.1)]
    rows += [("multi", 1, 0.5, None, 0.01), ("multi", 4, None, 0.99, None), ("none", 7, None, None, None)]
    table = t.spark.createDataFrame(rows, scoreboards.BANDS)
    done = scoreboards.banded(rates.withColumn("scheme", scheme), table)
    return done.select("model", "task", "points")


@query
def unioned_runs(t: Tables) -> DataFrame:
    first = t.run_results.where("model < 2").select("id", "task", _r6("score").alias("score"))
    second = t.run_results.where("model >= 2").select("id", "success", "task")
    return scoreboards.union_runs(first, second)


@query
def pending_items(t: Tables) -> DataFrame:
    return scoreboards.pending_items(t.items, t.preds).select("id", "task")


@query
def running_scores(t: Tables) -> DataFrame:
    """Scores have four digits; as whole numbers their sums are exact."""
    whole = F.round(F.col("score") * 10_000)
    results = t.run_results.withColumnRenamed("model", "run").withColumn("score", whole)
    done = scoreboards.running_score(results)
    millionths = F.floor(F.col("score") * 100 + 0.5)
    return done.select("run", "id", "items", (millionths / 1e6).alias("score"))


# === ranking ====================================================================================


@query
def top_disease_candidates(t: Tables) -> DataFrame:
    return ranking.top_candidates(t.gene_disease, 10, ["disease"], "rnk").select("disease", "uid")


@query
def first_present_summaries(t: Tables) -> DataFrame:
    hits = t.gene_disease.join(t.gene.select("uid", "summary"), "uid")
    return ranking.first_present(hits, "summary", ["disease"], "rnk")


# === judging =====================================================================================


@query
def judge_scores(t: Tables) -> DataFrame:
    done = judging.judge_scores(t.verdicts, key="quality")
    return done.select(
        "quality", "verdicts",
        _r6("judge_score").alias("judge_score"), _r6("unreadable").alias("unreadable"),
    )


@query
def win_rates(t: Tables) -> DataFrame:
    """Best score of two named models per task and block of ids decides the choice."""

    def best(model: int) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("score")))

    blocks = t.run_results.groupBy("task", F.floor(F.col("id") / 5).alias("block"))
    compared = blocks.agg(best(0).alias("a"), best(1).alias("b"), best(2).alias("c"))
    rows = F.array(
        F.struct(F.lit(0).alias("model_a"), F.lit(1).alias("model_b"),
                 F.col("a").alias("x"), F.col("b").alias("y")),
        F.struct(F.lit(0).alias("model_a"), F.lit(2).alias("model_b"),
                 F.col("a").alias("x"), F.col("c").alias("y")),
    )
    verdict = F.when(F.col("x") >= F.col("y"), "Choice: A\nRationale: higher").when(
        F.col("x") < F.col("y"), "Choice: B\nRationale: higher"
    )
    read = judging.read_verdicts(
        compared.select(F.inline(rows)).withColumn("verdict", verdict)
    )
    return judging.win_rate(read).withColumn("win_rate", _r6("win_rate"))


# === streaming ===================================================================================


def _stream_rows(events: DataFrame) -> DataFrame:
    is_error = F.col("event_type") == "error"
    return events.select(
        "ts",
        F.col("event_type").alias("task"),
        (~is_error).alias("success"),
        F.when(is_error, 0.0).otherwise(F.least(F.col("value") / 100, F.lit(1.0))).alias("score"),
    )


@query
def streamed_scoreboard(t: Tables) -> DataFrame:
    """The event stream drained to its end, open windows included."""
    schema = t.read("events").schema
    # A glob takes a table that is one file as well as one that is a folder of files.
    stream = t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/[e]vents.parquet")
    root = scratch_path(t.spark, "stream")
    done = streams.drain_scoreboard(_stream_rows(stream), f"{root}/table", f"{root}/checkpoint")
    return done.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "task", "items",
        _r6("success_rate").alias("success_rate"), _r6("score").alias("score"),
    )


@query
def windowed_scoreboard(t: Tables) -> DataFrame:
    """The batch twin of the streamed scoreboard."""
    done = streams.stream_scoreboard(_stream_rows(t.read("events")))
    return done.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "task", "items",
        _r6("success_rate").alias("success_rate"), _r6("score").alias("score"),
    )
