"""Normalise answers and score them, one projection and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from evalspark.functions import fixed, metrics, vectors
from evalspark.functions.metrics import Metric, check_mode
from evalspark.functions.text import join_list, list_literal


def _as_text(df: DataFrame, column: str) -> Column:
    """A list answer counts as its elements joined by a blank."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return join_list(F.col(column))
    return F.col(column)


def normalise_answers(
    df: DataFrame, column: str = "raw_prediction", into: str = "normalised"
) -> DataFrame:
    """Adds the normalised answer (array of texts); null where it cannot be made."""
    return metrics.with_normalised(df, {into: _as_text(df, column)})


def score_answers(
    df: DataFrame,
    mode: str = "as_documented",
    registry: dict[str, Metric] | None = None,
    distances: bool = False,
) -> DataFrame:
    """Result rows with processed_prediction, score, success, status.

    Input: task, answer (gold), raw_prediction and optionally success. A row whose
    call failed or whose answer cannot be normalised scores 0.0 with success false
    and has no prediction texts. ``registry`` adds or replaces metrics by task.
    ``distances`` adds edit distance and fuzzy ratio of the normalised texts.
    """
    chosen = {**metrics.metric_registry(mode), **(registry or {})}
    task = F.col("task")
    called = F.col("raw_prediction").isNotNull()
    if "success" in df.columns:
        called = called & F.coalesce(F.col("success"), F.lit(False))
    prepared = metrics.with_normalised(
        df.withColumn("_called", called),
        {"_pred": _as_text(df, "raw_prediction"), "_gold": _as_text(df, "answer")},
    )
    if distances:
        prepared = _with_texts(prepared)
    ok = F.col("_called") & F.col("_pred").isNotNull() & F.col("_gold").isNotNull()
    if check_mode(mode) == "as_coded":
        # This task yields lists, which its (default) text metric cannot compare.
        ok = ok & (task != fixed.TASK_DISEASE_LOCATION)
    listed = task.isin(*metrics.LIST_TASKS)
    processed = F.when(listed, list_literal(F.col("_pred"))).otherwise(
        F.get("_pred", F.lit(0))
    )
    score = metrics.task_score(task, F.col("_pred"), F.col("_gold"), chosen)
    status = (
        F.when(~F.col("_called"), "no_answer")
        .when(F.col("_pred").isNull() | F.col("_gold").isNull(), "not_normalised")
        .when(~ok, "not_scored")
        .otherwise("ok")
    )
    replaced = ("raw_prediction", "processed_prediction", "score", "success", "status")
    kept = [c for c in df.columns if c not in replaced]
    return prepared.select(
        *kept,
        F.when(ok, F.col("raw_prediction")).alias("raw_prediction"),
        F.when(ok, processed).alias("processed_prediction"),
        F.when(ok, F.coalesce(score, F.lit(0.0))).otherwise(0.0).alias("score"),
        ok.alias("success"),
        status.alias("status"),
        *(_distance_columns("_pred", "_gold") if distances else ()),
    )


def _with_texts(prepared: DataFrame) -> DataFrame:
    """List answers as one text each, for distances."""
    sides = prepared.withColumns(
        {f"{c}_text": join_list(F.col(c), ", ") for c in ("_pred", "_gold")}
    )
    distance = metrics.edit_distance(F.col("_pred_text"), F.col("_gold_text"))
    return sides.withColumn("_distance", distance)


def score_on_success(scored: DataFrame) -> DataFrame:
    """Adds the score of successful rows alone; failed rows have none here."""
    return scored.withColumn("score_on_success", F.when(F.col("success"), F.col("score")))


def _distance_columns(pred: str, gold: str) -> tuple[Column, Column]:
    sides, distance = (F.col(f"{pred}_text"), F.col(f"{gold}_text")), F.col("_distance")
    return (
        distance.alias("edit_distance"),
        metrics.fuzzy_ratio(*sides, distance).alias("fuzzy_ratio"),
    )


def edit_distances(df: DataFrame, pred: str = "raw_prediction") -> DataFrame:
    """Adds edit distance and fuzzy ratio of the normalised prediction and gold."""
    sides = _with_texts(
        metrics.with_normalised(
            df, {"_pred": _as_text(df, pred), "_gold": _as_text(df, "answer")}
        )
    )
    return sides.select(*df.columns, *_distance_columns("_pred", "_gold"))


def score_with_context(df: DataFrame, mode: str = "as_documented") -> DataFrame:
    """Task score, edit distance, fuzzy ratio and, with vectors present, cosine."""
    scored = score_answers(df, mode, distances=True)
    if {"pred_vector", "gold_vector"} <= set(df.columns):
        scored = scored.withColumn(
            "cosine_similarity",
            vectors.cosine(F.col("pred_vector"), F.col("gold_vector")),
        )
    return scored
