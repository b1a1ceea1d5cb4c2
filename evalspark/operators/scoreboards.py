"""Scoreboards, model comparison, coverage, running scores.

All of them aggregate to (task, …) sums first. Those partial sums are a handful of
rows, so totals, margins and ratios are taken from them and not from the result rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from evalspark.functions import fixed
from evalspark.sources import sums


def board_sums(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What every board is made of, per key; sums of two tables add up to those of both."""
    has_score = F.col("score").isNotNull() & ~F.isnan("score")
    aggregates = [
        F.count(F.lit(1)).alias("items"),
        F.count(F.when(F.col("success"), 1)).alias("successes"),
        F.sum(F.when(has_score, F.col("score"))).alias("score_sum"),
        F.count(F.when(has_score, 1)).alias("scored"),
    ]
    if "edit_distance" in results.columns:
        aggregates += [
            F.sum("edit_distance").alias("distance_sum"),
            F.count("edit_distance").alias("distances"),
        ]
    return results.groupBy(*keys).agg(*aggregates)


def _total(column: str) -> Column:
    return F.sum(column)


def _ratio(top: str, bottom: str) -> Column:
    return F.try_divide(F.sum(top), F.sum(bottom))


def scoreboard(results: DataFrame) -> DataFrame:
    """Score per task and over all rows (task null, is_total 1), sums and counts.

    The overall score is the mean over rows, not the mean of the task means.
    """
    return board_of_sums(board_sums(results, ["task"]))


def board_of_sums(found: DataFrame) -> DataFrame:
    """The scoreboard of sums that have ``task`` among their keys."""
    return found.rollup("task").agg(
        F.grouping("task").cast("int").alias("is_total"),
        _total("items").alias("items"),
        _ratio("successes", "items").alias("success_rate"),
        _total("score_sum").alias("score_sum"),
        _ratio("score_sum", "scored").alias("score"),
    )


def success_rate(results: DataFrame) -> DataFrame:
    """Share of rows that succeeded; a row that does not say so did not."""
    return results.agg(F.avg(F.coalesce("success", F.lit(False)).cast("int")).alias("success_rate"))


def fold_results(results: DataFrame, root: str, batch: int, keys: Sequence[str] = ("task",)) -> None:
    """Add new results to the board kept at ``root``; the same batch again counts once."""
    sums.add_batch(board_sums(results, keys), root, batch)


def folded_scoreboard(spark: SparkSession, root: str, keys: Sequence[str] = ("task",)) -> DataFrame:
    """The scoreboard of all results folded in so far, from their sums alone."""
    found = sums.read_sums(spark, root, keys)
    if found is None:
        raise ValueError(f"{root}: no results were folded in")
    return board_of_sums(found)


def overall_score(results: DataFrame) -> DataFrame:
    has_score = ~F.isnan("score")
    return results.agg(F.avg(F.when(has_score, F.col("score"))).alias("overall_score"))


def score_by_task(results: DataFrame) -> DataFrame:
    return results.groupBy("task").agg(
        F.avg(F.when(~F.isnan("score"), F.col("score"))).alias("score")
    )


def edit_distance_by_task(results: DataFrame) -> DataFrame:
    """Mean edit distance per task and over all rows (task null)."""
    return (
        board_sums(results, ["task"])
        .rollup("task")
        .agg(
            F.grouping("task").cast("int").alias("is_total"),
            _ratio("distance_sum", "distances").alias("edit_distance"),
            _total("distances").alias("pairs"),
        )
    )


def metrics_long(board: DataFrame) -> DataFrame:
    """Scoreboard -> (key, value): success_rate, overall_score, score_<task>.

    Rows without a task are a group of the board; its key is ``score_`` alone.
    """
    is_total = F.col("is_total") == 1
    name = F.coalesce(F.replace("task", F.lit(" "), F.lit("_")), F.lit(""))
    task_key = F.concat(F.lit("score_"), name)
    overall = F.array(
        F.struct(F.lit("success_rate").alias("key"), F.col("success_rate").alias("value")),
        F.struct(F.lit("overall_score").alias("key"), F.col("score").alias("value")),
    )
    single = F.array(F.struct(task_key.alias("key"), F.col("score").alias("value")))
    return board.select(
        F.inline(F.when(is_total, overall).otherwise(single))
    )


def chart_table(results: DataFrame) -> DataFrame:
    """Score per task with the overall score on each row.

    The total is a window over the per-task sums, which are as few as the tasks.
    """
    by_task = board_sums(results, ["task"])
    everything = Window.partitionBy(F.lit(1))
    return by_task.select(
        "task",
        F.try_divide("score_sum", "scored").alias("score"),
        F.try_divide(
            F.sum("score_sum").over(everything), F.sum("scored").over(everything)
        ).alias("overall_score"),
    )


# --- models --------------------------------------------------------------------------


def compare_runs(
    results: DataFrame, column: str, values: Sequence, keys: Sequence[str] = ("task",)
) -> DataFrame:
    """One score column per value of a column; naming them avoids a job to find them.

    With two or more values, ``difference`` is the last one minus the first. For example,
    ``compare_runs(results, "tools", [False, True], ["benchmark", "task"])`` tells what
    tools add to each task of each benchmark.
    """
    per_run = board_sums(results, [*keys, column])
    columns = []
    for value in values:
        own = F.col(column) == value
        columns.append(
            F.try_divide(
                F.sum(F.when(own, F.col("score_sum"))),
                F.sum(F.when(own, F.col("scored"))),
            ).alias(f"score_{value}")
        )
    wide = per_run.groupBy(*keys).agg(*columns)
    if len(values) > 1:
        wide = wide.withColumn(
            "difference", F.col(f"score_{values[-1]}") - F.col(f"score_{values[0]}")
        )
    return wide


def compare_models(
    results: DataFrame, models: Sequence, keys: Sequence[str] = ("task",)
) -> DataFrame:
    """:func:`compare_runs` of named models."""
    return compare_runs(results, "model", models, keys)


def score_cube(
    results: DataFrame, keys: Sequence[str] = ("model", "task")
) -> DataFrame:
    """Score for every combination of the keys, with margins (null = all)."""
    return (
        board_sums(results, keys)
        .cube(*keys)
        .agg(
            F.grouping_id().cast("int").alias("margin"),
            _total("items").alias("items"),
            _ratio("score_sum", "scored").alias("score"),
        )
    )


def union_runs(*runs: DataFrame) -> DataFrame:
    """Results of several runs in one table; a column a run lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


# --- coverage -------------------------------------------------------------------------


def coverage(items: DataFrame, results: DataFrame) -> DataFrame:
    """Share of the items of each task, and of all, that have a result."""
    answered = results.select("id").distinct().withColumn("answered", F.lit(1))
    counts = (
        items.select("id", "task")
        .join(answered, "id", "left")
        .groupBy("task")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.count("answered").alias("answered"),
        )
    )
    return counts.rollup("task").agg(
        F.grouping("task").cast("int").alias("is_total"),
        F.sum("items").alias("items"),
        F.sum("answered").alias("answered"),
        _ratio("answered", "items").alias("coverage"),
    )


def pending_items(items: DataFrame, results: DataFrame) -> DataFrame:
    """Items without a successful result yet."""
    return items.join(results.where("success").select("id"), "id", "left_anti")


def threshold_band(scores: DataFrame, bands: Sequence = fixed.BANDS_HOSTED) -> DataFrame:
    """Points of the highest band whose limits are met (coverage, exact_match); else 0."""
    rows = [
        ("", reward, None if everything else float(over), 1.0 if everything else None, float(exact_over))
        for reward, over, everything, exact_over in bands
    ]
    table = scores.sparkSession.createDataFrame(rows, BANDS)
    return banded(scores.withColumn("_scheme", F.lit("")), table, "_scheme").drop("_scheme")


#: A band: coverage above ``over`` or from ``least`` on, exact matches above ``exact_over``.
BANDS = "scheme STRING, points INT, over DOUBLE, least DOUBLE, exact_over DOUBLE"


def banded(scores: DataFrame, bands: DataFrame, scheme: str = "scheme") -> DataFrame:
    """``scores`` with the ``points`` of the best band of their scheme they reach, else 0.

    ``bands`` is a table, so schemes can differ by benchmark and change without code. A
    scheme's bands meet its scores in one equi-join, sorted by points from the highest:
    the first whose limits are met counts. A missing limit is met by all; scores without
    coverage or exact matches reach no limit; a scheme without bands gives 0.
    """
    listed = bands.groupBy(F.col("scheme").alias("_of")).agg(
        F.sort_array(F.collect_list(F.struct("points", "over", "least", "exact_over")), asc=False).alias("_bands")
    )

    def met(band: Column) -> Column:
        limits = (
            (band["over"].isNull(), F.col("coverage") > band["over"]),
            (band["least"].isNull(), F.col("coverage") >= band["least"]),
            (band["exact_over"].isNull(), F.col("exact_match") > band["exact_over"]),
        )
        return reduce(lambda a, b: a & b, [none | F.coalesce(reached, F.lit(False)) for none, reached in limits])

    joined = scores.join(listed, F.col(scheme).eqNullSafe(F.col("_of")), "left")
    points = F.coalesce(F.get(F.filter("_bands", met), F.lit(0))["points"], F.lit(0))
    return joined.withColumn("points", points).drop("_of", "_bands")


# --- order and progress ------------------------------------------------------------------


def order_results(board: DataFrame) -> DataFrame:
    """Tasks in name order, the total last."""
    return board.orderBy("is_total", "task")


def running_score(
    results: DataFrame, keys: Sequence[str] = ("run",), block_bits: int = 20
) -> DataFrame:
    """Mean score of a run up to and including each id -> (keys, id, items, score).

    A run may hold most of the rows, so its ids are never ordered in one task. Ids are
    cut into blocks of 2^block_bits, those into blocks of blocks; sums run within each
    level, and a row adds up what lies before it on all three. A null key is a run like
    any other. Rows without an id have no place in the order: like the rows of one id
    they come back as one row of their run, with null items and score.
    """
    names, keys = list(keys), ["_run"]
    # A struct is not null, so the joins below find runs with null keys too.
    results = results.select(
        F.struct(*names).alias("_run"), "id", F.col("score").cast("double").alias("score")
    )
    # The coalesce tells the optimizer that no block number is null. Without it each
    # join below filters its own level, and the levels cannot share the row exchange.
    counted = F.when(F.col("id").isNotNull(), F.col("score"))
    rows = results.groupBy(*keys, "id").agg(
        F.sum(counted).alias("s"), F.count(counted).alias("n")
    )
    fine = F.shiftright(F.coalesce("id", F.lit(0)), block_bits)
    coarse = F.shiftright("fine", block_bits)
    rows = rows.withColumn("fine", fine)

    blocks = (
        rows.groupBy(*keys, "fine")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .withColumn("coarse", coarse)
    )
    groups = blocks.groupBy(*keys, "coarse").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")
    )

    def before(df: DataFrame, scope: Sequence[str], order: str, tag: str) -> DataFrame:
        window = (
            Window.partitionBy(*keys, *scope)
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return df.select(
            *keys,
            order,
            *scope,
            F.coalesce(F.sum("s").over(window), F.lit(0.0)).alias(f"s_{tag}"),
            F.coalesce(F.sum("n").over(window), F.lit(0)).alias(f"n_{tag}"),
        )

    group_start = before(groups, [], "coarse", "g")
    block_start = before(blocks, ["coarse"], "fine", "b").join(
        group_start, [*keys, "coarse"]
    )
    inside = (
        Window.partitionBy(*keys, "fine")
        .orderBy("id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = rows.select(
        *keys,
        "id",
        "fine",
        F.coalesce(F.sum("s").over(inside), F.lit(0.0)).alias("s"),
        F.sum("n").over(inside).alias("n"),
    )
    seen = F.col("n") + F.col("n_b") + F.col("n_g")
    mean = F.try_divide(F.col("s") + F.col("s_b") + F.col("s_g"), seen)
    placed = F.col("id").isNotNull()
    return own.join(block_start, [*keys, "fine"]).select(
        "_run.*",
        "id",
        F.when(placed, seen).alias("items"),
        F.when(placed, mean).alias("score"),
    )
