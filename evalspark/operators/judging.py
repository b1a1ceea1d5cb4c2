"""Read judge verdicts and turn them into reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evalspark.functions import fixed, text


def read_verdicts(df: DataFrame, column: str = "verdict") -> DataFrame:
    """Adds judge_score (1-5, else null), explanation and choice (A/B, else null)."""
    verdict = F.col(column)
    number = text.first_group(verdict, fixed.VERDICT_SCORE_PATTERN).try_cast("int")
    return df.withColumns(
        {
            "judge_score": F.when(number.between(1, 5), number),
            "explanation": text.first_group(
                verdict, fixed.VERDICT_EXPLANATION_PATTERN
            ),
            "choice": text.first_group(verdict, fixed.VERDICT_CHOICE_PATTERN),
        }
    )


def judge_scores(df: DataFrame, key: str = "task", column: str = "verdict") -> DataFrame:
    """Mean judge score per key and the share of verdicts that cannot be read."""
    read = read_verdicts(df, column)
    return read.groupBy(key).agg(
        F.count(F.lit(1)).alias("verdicts"),
        F.avg("judge_score").alias("judge_score"),
        F.avg(F.col("judge_score").isNull().cast("int")).alias("unreadable"),
    )


def win_rate(verdicts: DataFrame) -> DataFrame:
    """Share of comparisons won, per model and opponent.

    Input (model_a, model_b, choice); a row without a choice does not count.
    """

    def side(own: str, other: str, letter: str):
        return F.struct(
            F.col(own).alias("model"),
            F.col(other).alias("opponent"),
            (F.col("choice") == letter).cast("int").alias("won"),
        )

    sides = F.array(side("model_a", "model_b", "A"), side("model_b", "model_a", "B"))
    return (
        verdicts.where(F.col("choice").isin("A", "B"))
        .select(F.inline(sides))
        .groupBy("model", "opponent")
        .agg(F.count(F.lit(1)).alias("comparisons"), F.avg("won").alias("win_rate"))
    )


def judge_report(df: DataFrame, key: str = "task", column: str = "verdict") -> DataFrame:
    return judge_scores(df, key, column).orderBy(key)
