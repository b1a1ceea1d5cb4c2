"""Readers: benchmark, answer and record files -> DataFrames with fixed schemas.

The format is what the caller says, never what a file's suffix suggests. A document
file (one JSON value per file) is one row until it is parsed, so it has to fit a text
value; any number of such files is read in parallel. Larger sets come as JSON lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from evalspark.sources import parsers

#: Marks a missing value in CSV results, so that the answer text NA stays a text.
NULL_TOKEN = "\\N"

ITEM_SCHEMA = "id LONG, task STRING, question STRING, answer STRING"
PREDICTION_SCHEMA = (
    "id LONG, task STRING, question STRING, answer STRING, explanation STRING, "
    "success BOOLEAN"
)
RESULT_SCHEMA = (
    "id LONG, task STRING, question STRING, answer STRING, raw_prediction STRING, "
    "processed_prediction STRING, score DOUBLE, success BOOLEAN"
)


def read_documents(spark: SparkSession, path) -> DataFrame:
    """Whole files -> (path, value)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One document per line -> (path, value); files are split between tasks."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def read_nested_qa(spark: SparkSession, path) -> DataFrame:
    return parsers.parse_nested_qa(read_documents(spark, path))


def read_question_list(spark: SparkSession, path) -> DataFrame:
    return parsers.parse_question_list(read_documents(spark, path))


def read_benchmark(spark: SparkSession, path, kind: str = "nested") -> tuple[DataFrame, DataFrame]:
    """Rows of benchmark files and what could not be read: (path, part, reason, text).

    ``kind`` is ``nested`` or ``list``. A broken file does not stop the others, and is not
    lost without a trace either: each file has rows, no questions, or a reject. Spark
    passes over files without a byte; they hold no document.
    """
    parse = {"nested": parsers.nested_qa, "list": parsers.question_list}[kind]
    return parse(read_documents(spark, path))


def read_replies(spark: SparkSession, path, kind: str) -> tuple[DataFrame, DataFrame]:
    """Rows of stored replies of one kind and (path, key, reason, text) of broken ones."""
    key = {"search": "term", "link": "rsid", "gene_xml": "uid"}.get(kind)
    if key is None:
        return parsers.checked_replies(read_lines(spark, path), kind)
    lines = spark.read.schema(f"{key} STRING, value STRING, _corrupt_record STRING").json(path)
    named = lines.select(F.col("_metadata.file_path").alias("path"), key, "value", "_corrupt_record")
    return parsers.checked_replies(named, kind)


def read_items(spark: SparkSession, path) -> DataFrame:
    """Item table as JSON lines, for sets too large for one document."""
    return spark.read.schema(ITEM_SCHEMA).json(path)


def read_predictions(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """A JSON array of answers per file, or one answer per line."""
    reader = spark.read.schema(PREDICTION_SCHEMA)
    return reader.json(path, multiLine=multi_line)


def read_paired(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """Nested {predicted, true} document per file, or a fragment of one per line."""
    docs = read_lines(spark, path) if lines else read_documents(spark, path)
    return parsers.parse_paired(docs)


def read_results(spark: SparkSession, path, null_token: str = NULL_TOKEN) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).csv(
        path,
        header=True,
        multiLine=True,
        quote='"',
        escape='"',
        nullValue=null_token,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def _keyed_lines(spark: SparkSession, path, key: str) -> DataFrame:
    """JSON lines {key, value} of stored replies; ``value`` is the reply text."""
    return spark.read.schema(f"{key} STRING, value STRING").json(path)


def read_search_docs(spark: SparkSession, path, k: int | None = None) -> DataFrame:
    return parsers.parse_search_docs(_keyed_lines(spark, path, "term"), k)


def read_summary_docs(spark: SparkSession, path) -> DataFrame:
    return parsers.parse_summary_docs(read_lines(spark, path))


def read_snp_docs(spark: SparkSession, path) -> DataFrame:
    return parsers.parse_snp_docs(read_lines(spark, path))


def read_link_docs(spark: SparkSession, path) -> DataFrame:
    return parsers.parse_link_docs(_keyed_lines(spark, path, "rsid"))


def read_gene_xml(spark: SparkSession, path) -> DataFrame:
    return parsers.parse_gene_xml(_keyed_lines(spark, path, "uid"))
