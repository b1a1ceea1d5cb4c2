"""Sums that grow by batches: new results are folded in without reading old ones.

A table of sums is a folder of batches, each the sums of its results per key, and of bases,
each the sums of all batches up to one. A batch has a number and a folder of its own; the
same batch again replaces itself, so a repeated call counts once. The sums of the table are
those of the newest whole base and of the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from evalspark.session import folder_names


def add_batch(sums: DataFrame, root: str, batch: int) -> None:
    """Write the sums of one batch; ``batch`` numbers rise, the last one may come again."""
    sums.write.mode("overwrite").parquet(f"{root}/batches/batch={batch:012d}")


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the whole folders: Spark marks a folder when all its files are there."""
    names = [n for n in folder_names(spark, folder) if n.startswith("batch=")]
    return [int(n[6:]) for n in names if "_SUCCESS" in folder_names(spark, f"{folder}/{n}")]


def read_sums(spark: SparkSession, root: str, keys: Sequence[str], through: int | None = None) -> DataFrame | None:
    """The sums per key, of all batches or those ``through`` one; None without any.

    Every column but the keys is a sum. Keys may be null.
    """
    bases = [b for b in _numbers(spark, f"{root}/bases") if through is None or b <= through]
    base = max(bases, default=-1)
    later = [b for b in _numbers(spark, f"{root}/batches") if b > base and (through is None or b <= through)]
    paths = [f"{root}/bases/batch={base:012d}"] if base >= 0 else []
    paths += [f"{root}/batches/batch={b:012d}" for b in later]
    if not paths:
        return None
    parts = spark.read.parquet(*paths)
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in keys])


def compact(spark: SparkSession, root: str, keys: Sequence[str]) -> int | None:
    """Make a base of all whole batches; its number. A base that was not finished is ignored."""
    last = max(_numbers(spark, f"{root}/batches"), default=None)
    if last is not None and last not in _numbers(spark, f"{root}/bases"):
        read_sums(spark, root, keys, last).write.mode("overwrite").parquet(f"{root}/bases/batch={last:012d}")
    return last


def next_batch(spark: SparkSession, root: str) -> int:
    return max([*_numbers(spark, f"{root}/batches"), *_numbers(spark, f"{root}/bases"), -1]) + 1
