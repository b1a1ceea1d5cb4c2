"""Join answers with gold: by id, by question text, without a partner, best of several."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evalspark.functions import fixed, text


def pair_by_id(pred: DataFrame, gold: DataFrame, how: str = "inner") -> DataFrame:
    """Predictions with the gold answer of the same id -> (…, gold_answer).

    With ``how="left"`` a prediction without gold keeps its row, with a ``note``.
    """
    answer = gold.select("id", F.col("answer").alias("gold_answer"), F.lit(True).alias("_found"))
    joined = pred.join(answer, "id", how)
    if how == "left":
        note = F.when(F.col("_found").isNull(), F.lit(fixed.NO_GOLD_NOTE))
        joined = joined.withColumn("note", note)
    return joined.drop("_found")


def gold_by_question(gold: DataFrame) -> DataFrame:
    """(question_key, gold_answer), one row per gold answer, across tasks.

    ``gold`` holds question and answers (array).
    """
    return gold.select(
        text.question_key(F.col("question")).alias("question_key"),
        F.explode("answers").alias("gold_answer"),
    )


def pair_by_question(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Every gold answer to the trimmed question text, in any task.

    A prediction without gold keeps one row with a null answer and a note.
    """
    keyed = pred.withColumn("question_key", text.question_key(F.col("question")))
    joined = keyed.join(gold_by_question(gold), "question_key", "left")
    note = F.when(F.col("gold_answer").isNull(), F.lit(fixed.NO_GOLD_NOTE))
    return joined.withColumn("note", note)


def unmatched(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Predictions whose question has no gold answer at all."""
    keyed = pred.withColumn("question_key", text.question_key(F.col("question")))
    return (
        keyed.join(gold_by_question(gold), "question_key", "left_anti")
        .withColumn("gold_answer", F.lit(None).cast("string"))
        .withColumn("score", F.lit(None).cast("double"))
        .withColumn("note", F.lit(fixed.NO_GOLD_NOTE))
    )


def best_gold(paired: DataFrame, score: str = "score") -> DataFrame:
    """Several gold answers per id -> the best and the mean score."""
    return paired.groupBy("id").agg(
        F.max(score).alias("best_score"),
        F.avg(score).alias("mean_score"),
        F.count(score).alias("gold_answers"),
    )
