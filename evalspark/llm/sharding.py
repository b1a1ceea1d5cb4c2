"""Shuffle rows into shards of exact sizes with a hypergeometric communication matrix.

A uniform shuffle sends from input partition p to shard s a number of rows that follows a
multivariate hypergeometric law. These counts are drawn first, given the rows of each
partition and the exact shard sizes. Then each partition permutes its rows and deals them
out by its row of the matrix, the rows are exchanged, and each shard permutes what it got.

Rows are handled by built-in functions only. The matrix is drawn on the driver from one
count per input partition.
"""

from __future__ import annotations

import math
import random
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.common import REST, stored, unwrapped, wrapped

#: A shard's rows are permuted in so many ranges of their random number.
RANGES = 1024


def hypergeometric(marked: int, others: int, drawn: int, rng: random.Random) -> int:
    """Marked ones among ``drawn`` of ``marked + others``.

    Few draws are made one by one. Else rejection under the universal bound for
    log-concave laws around the mode, whose number of trials does not grow with the
    arguments.
    """
    least, most = max(0, drawn - others), min(drawn, marked)
    if least == most:
        return least
    if drawn <= 24:
        found, total = 0, marked + others
        for i in range(drawn):
            found += rng.random() * (total - i) < marked - found
        return found
    def log_ways(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    every = log_ways(marked + others, drawn)
    mode = (drawn + 1) * (marked + 1) // (marked + others + 2)
    mode = min(max(mode, least), most)
    peak = math.exp(min(0.0, log_ways(marked, mode) + log_ways(others, drawn - mode) - every))
    flat = 1 + peak / 2
    while True:
        tail = rng.random() > flat / (1 + flat)
        far = (flat + rng.expovariate(1.0) if tail else rng.random() * flat) / peak
        step = round(far)
        value = mode + (step if rng.random() < 0.5 else -step)
        under = rng.random() * min(1.0, math.exp(flat - peak * far))
        if least <= value <= most:
            chance = math.exp(log_ways(marked, value) + log_ways(others, drawn - value) - every)
            if under * peak <= chance:
                return value


def matrix(rows: list[int], shards: list[int], rng: random.Random) -> list[list[int]]:
    """Counts from each partition to each shard with these sums, as a shuffle gives them."""
    left, out = list(shards), []
    for count in rows:
        others, line = sum(left), []
        for s, room in enumerate(left):
            others -= room
            took = hypergeometric(room, others, count, rng) if others else count
            left[s] -= took
            count -= took
            line.append(took)
        out.append(line)
    return out


def even_sizes(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def sharded(docs: DataFrame, shards: int = 8, seed: int = 29) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (from 0, without gaps).

    All assignments of rows to places are equally likely, and shard sizes differ by one
    at most. Rows are told apart by their place in the input, so repeated rows, null ids
    and null texts are dealt like any others. Shards stay empty if there are fewer rows.
    Input columns named ``shard`` or ``slot`` are replaced.

    The rows are stored once with their partition and number, which fixes both for all
    later steps and retries. Local permutations order one input partition at a time, or
    one of 1024 ranges of a shard's random numbers; a range's first slot is the sum of the
    counts of the ranges before it.
    """
    new = ("shard", "slot")
    numbered = stored(
        wrapped(docs.drop(*new)).select(
            REST,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    # One row per input partition, as wide as there are shards.
    counts = sorted(map(tuple, numbered.groupBy("_part").count().collect()))
    sizes = even_sizes(sum(n for _, n in counts), shards)
    rng = random.Random(seed)
    rng.shuffle(sizes)
    drawn = matrix([n for _, n in counts], sizes, rng)
    ends = [[p, [sum(line[: s + 1]) for s in range(shards)]] for (p, _), line in zip(counts, drawn)]
    plan = numbered.sparkSession.createDataFrame(ends, "_part int, _ends array<long>")

    def mixed(salt: int):
        return F.xxhash64(F.lit(seed), F.lit(salt), "_row")

    place = F.row_number().over(Window.partitionBy("_part").orderBy(mixed(1), "_row"))
    dealt = (
        numbered.withColumn("_place", place)
        .join(plan, "_part")
        # The first shard whose end is not below the place.
        .withColumn("shard", F.size(F.filter("_ends", lambda end: end < F.col("_place"))))
        .drop("_place", "_ends", "_part")
        .withColumn("_key", mixed(2))
        .withColumn("_range", F.shiftrightunsigned("_key", 64 - (RANGES - 1).bit_length()).cast("int"))
    )
    dealt = stored(dealt, "shard-dealt")
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("shard", "_range")
        .count()
        .withColumn("_base", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    local = F.row_number().over(Window.partitionBy("shard", "_range").orderBy("_key", "_row"))
    return (
        dealt.withColumn("_local", local)
        .join(bases, ["shard", "_range"])
        .withColumn("slot", (F.col("_base") + F.col("_local") - 1).cast("long"))
        .select(*unwrapped(docs, without=new), *new)
    )


def shard_of(place: int, ends: list[int]) -> int:
    """The rule of the join above for one place (from 1)."""
    return bisect_left(ends, place)
