"""Writers: answers, results and paired predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from evalspark.sources.readers import NULL_TOKEN


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Answers as JSON, one object per line; null fields are written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_items(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select("id", "task", "question", "answer").write.mode(mode).json(path)


def _edge(df: DataFrame, column: str) -> Column:
    """One value as itself, several as a list."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.ArrayType):
        listed = F.to_variant_object(value)
        alone = F.try_variant_get(listed, "$[0]", "variant")
        return F.when(F.array_size(value) == 1, alone).otherwise(listed)
    return F.try_variant_get(F.to_variant_object(F.array(value)), "$[0]", "variant")


def paired_lines(df: DataFrame) -> DataFrame:
    """(task, question, predicted, true) -> one nested JSON fragment per row."""
    pair = F.struct(_edge(df, "predicted").alias("predicted"), _edge(df, "true").alias("true"))
    fragment = F.create_map("task", F.create_map("question", pair))
    return df.select(F.to_json(fragment, {"ignoreNullFields": "false"}).alias("value"))


def write_paired(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Nested task -> question -> {predicted, true}, as fragments of one question.

    Each line has the full nested shape for its question, so a task with any number of
    questions is written by many tasks and without a shuffle.
    """
    paired_lines(df).write.mode(mode).text(path)


def paired_documents(df: DataFrame, benchmark: str) -> DataFrame:
    """(benchmark, task, question, …) -> lines whose texts, in order, are one JSON document
    per benchmark: (benchmark, line number, value).

    A row writes its own question, the opening of its task or document where it is the
    first, and the closing where it is the last; no task or document is gathered.
    """
    fragments = df.select(
        F.col(benchmark).alias("benchmark"),
        "task",
        "question",
        *[_edge(df, column).alias(column) for column in ("predicted", "true")],
    )
    body = F.to_json(F.struct("predicted", "true"), {"ignoreNullFields": "false"})
    order = ["task", "question"]
    whole = Window.partitionBy("benchmark").orderBy(*order)
    first, last = F.lag("task", 1).over(whole), F.lead("task", 1).over(whole)
    placed = fragments.select(
        "benchmark",
        "task",
        "question",
        body.alias("body"),
        F.row_number().over(whole).alias("line"),
        F.lead(F.lit(True)).over(whole).isNull().alias("ends"),
        (~F.coalesce(first.eqNullSafe(F.col("task")), F.lit(False)) | (F.row_number().over(whole) == 1)).alias("opens_task"),
        (~F.coalesce(last.eqNullSafe(F.col("task")), F.lit(False))).alias("closes_task"),
    )

    def name(column: str) -> Column:
        """A JSON text of the value, also null as the empty name."""
        listed = F.to_json(F.array(F.coalesce(F.col(column), F.lit(""))))
        return F.regexp_extract(listed, r"(?s)^\[(.*)\]$", 1)

    ends = F.col("ends")
    closes = F.col("closes_task") | ends
    value = F.concat(
        F.when(F.col("line") == 1, "{").otherwise(""),
        F.when(F.col("opens_task"), F.concat(name("task"), F.lit(": {"))).otherwise(""),
        name("question"),
        F.lit(": "),
        F.col("body"),
        F.when(ends, "}}").when(closes, "},").otherwise(","),
    )
    return placed.select("benchmark", "line", value.alias("value"))


def write_paired_documents(df: DataFrame, path: str, benchmark: str = "benchmark", mode: str = "errorifexists") -> None:
    """One valid nested JSON file per benchmark, in a folder ``benchmark=<name>``.

    A file's lines are sorted and written as they come, by one task to a benchmark and many
    benchmarks at a time; :func:`write_paired` writes one benchmark by many tasks.
    """
    lines = paired_documents(df, benchmark)
    ordered = lines.repartition("benchmark").sortWithinPartitions("benchmark", "line")
    ordered.drop("line").write.mode(mode).partitionBy("benchmark").text(path)


def write_results(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    null_token: str = NULL_TOKEN,
    most_rows: int = 250_000,
) -> None:
    """Results as CSV with a header; missing values are a token, so NA stays a text.

    Values may hold line ends, so a file is read whole by one task: after ``most_rows``
    rows a task starts another file.
    """
    df.write.mode(mode).option("maxRecordsPerFile", most_rows).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        nullValue=null_token,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_results_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
) -> None:
    """Results as Parquet, by default appended; partition by benchmark and model."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
