"""Ranked hits: first k per query, first that has a value, ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Parts that the hits of one query are cut within first.
SALTS = 64


def top_candidates(
    hits: DataFrame,
    k: int,
    query: Sequence[str] = ("query",),
    order: str = "rank",
    ties: Sequence[str] = (),
) -> DataFrame:
    """First ``k`` hits of each query in order, equal places by the columns ``ties``.

    For every k, hits are cut within 64 salted parts per query and then per query, so no
    task receives all hits of a query. Spark also puts a group limit before a shuffle
    where k is small enough for it.
    """
    part = F.pmod(F.xxhash64(*query, order), F.lit(SALTS))
    salted = hits.withColumn("_part", part)
    hits = _first(salted, k, [*query, "_part"], [order, *ties]).drop("_part")
    return _first(hits, k, query, [order, *ties])


def _first(hits: DataFrame, k: int, query: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*query).orderBy(*order)
    return (
        hits.withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") <= k)
        .drop("_place")
    )


def first_present(
    hits: DataFrame,
    value: str,
    query: Sequence[str] = ("query",),
    order: str = "rank",
) -> DataFrame:
    """First value, in order, that is neither null nor empty; null if there is none."""
    present = F.col(value).isNotNull() & (F.col(value).cast("string") != "")
    return hits.groupBy(*query).agg(
        F.min_by(value, F.when(present, F.col(order))).alias(value)
    )


def ordered_values(order: Column, value: Column) -> Column:
    """Non-null values in order, as an array: one answer, thus one row."""
    pairs = F.collect_list(
        F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))
    )
    return F.transform(F.array_sort(pairs), lambda pair: pair["v"])
