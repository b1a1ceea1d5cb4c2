"""Projections, filters and samples over item and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from evalspark.functions import fixed, text

ITEM_COLUMNS = ("id", "task", "question", "answer")


def item_view(df: DataFrame) -> DataFrame:
    """Item table in its fixed column order; ``id`` stays a column."""
    return df.select(*ITEM_COLUMNS)


def sample_items(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` items without replacement, the same ones for the same seed.

    The order is a digest of seed and id, so it depends on neither partitioning nor
    task retries; Spark keeps the first n of each partition and merges those.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    return df.orderBy(order, "id").limit(n)


def limit_items(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` items by id."""
    return df.orderBy("id").limit(n)


def valid_scores(df: DataFrame) -> DataFrame:
    score = F.col("score")
    return df.where(score.isNotNull() & ~F.isnan(score))


def with_question_key(df: DataFrame) -> DataFrame:
    return df.withColumn("question_key", text.question_key(F.col("question")))


def flatten_answers(df: DataFrame, column: str = "answers") -> DataFrame:
    """List answer -> one text, elements joined by a blank."""
    return df.withColumn("answer", text.join_list(F.col(column)))


def parse_list_literals(df: DataFrame, column: str = "answer") -> DataFrame:
    return df.withColumn("answers", text.parse_list_literal(F.col(column)))


def distinct_labels(df: DataFrame, column: str = "answers") -> DataFrame:
    """Duplicate labels of one answer count once; the first keeps its place."""
    return df.withColumn(column, F.array_distinct(F.col(column)))


def shared_labels(a: DataFrame, b: DataFrame) -> DataFrame:
    """Label rows found in both tables, once each.

    Both sides lose their repeats before the shuffle that compares them, so a label that
    most rows have is one row of each task.
    """
    return a.distinct().intersect(b.distinct())


def route_model(
    df: DataFrame, local_models: Sequence[str] = fixed.LOCAL_MODELS
) -> DataFrame:
    """Model name -> name of the backend that serves it."""
    backend = F.when(F.col("model").isin(*local_models), "local").otherwise("hosted")
    return df.withColumn("backend", backend)


def benchmark_view(df: DataFrame) -> DataFrame:
    """Items with their join key, list answer and flat answer in one projection."""
    answers = text.parse_list_literal(F.col("answer"))
    return df.select(
        "id",
        "task",
        "question",
        text.question_key(F.col("question")).alias("question_key"),
        F.array_distinct(answers).alias("answers"),
        text.join_list(answers).alias("answer"),
    )
