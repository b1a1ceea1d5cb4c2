"""Mix sources to target weights with Pareto order sampling.

Targets: sources share a multiple of all words by weight; a source stops at ``most`` times
its words and the excess is shared again. Inside a source, documents differ in how often
they should come by their length class; every document gets its certain whole copies, and
the remainder is an inclusion probability. Pareto order sampling then ranks the documents
of a source by random odds over inclusion odds and takes them in that order until the
source's words are reached.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.common import REST, WORD, stored, unwrapped, wrapped

#: Ranks are located by two rounds of counts, each over this many ranges.
RANGES = 4096
#: Weight of a document by its length class: short ones less often.
CLASS_STEP = 0.05


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_class(size: Column) -> Column:
    """Class 0 for no words, then one for each doubling."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def class_weight(length: Column) -> Column:
    """Wanted rate of a length class against others of its source."""
    return F.lit(1.0) + F.lit(CLASS_STEP) * F.least(length, F.lit(20))


def filled(parts: DataFrame, group: list[str], words: str, weight: str, total: Column, most: float):
    """Column ``share`` for each part: ``total`` by weight, at most ``most * words``.

    Parts that reach their bound are those with the smallest bound per weight, so one
    ordered window finds where the rest begin: parts are taken as bounded while an equal
    split of what is left would pass the bound of the next.
    """
    bound = F.col(words) * F.lit(float(most))
    order = Window.partitionBy(*group or [F.lit(0)]).orderBy(F.col("_ratio"), *parts.columns)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*group or [F.lit(0)])
    level = (F.col("_total") - F.coalesce(F.sum("_bound").over(before), F.lit(0.0))) / F.sum(
        weight
    ).over(onward)
    return (
        parts.withColumn("_bound", bound)
        .withColumn("_total", total.cast("double"))
        .withColumn("_ratio", F.try_divide("_bound", weight))
        .withColumn("_level", level)
        # Levels fall from the first part that stays below its bound: the largest is its.
        .withColumn("_free", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(whole))
        .withColumn("share", F.least("_bound", F.coalesce(F.col("_free"), F.lit(math.inf)) * F.col(weight)))
        .drop("_bound", "_total", "_ratio", "_level", "_free")
    )


def uniform(seed: int, *columns: Column) -> Column:
    """A number inside (0, 1) that depends on the columns alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with the columns ``size, source_size, target, taken`` in front.

    ``docs`` needs ``doc_id, text, source``. Sources in code point order, null last, weigh
    ``weights``, over and over, and share ``share`` times all words. ``taken`` is the
    words the mix takes: ``size`` times the copies, 0 to ``most``. Reruns agree, as the
    random numbers come from ids and texts; repeated rows draw the same number and are
    taken alike unless the target lies between them. Null texts have no words and are
    never taken, null sources form one source, without rows there is no result. Input
    columns with the names of new ones are replaced.

    A source's documents are never ordered as a whole: counts of words over ranges of the
    rank, in two rounds, narrow its limit down to one of 4096 * 4096 ranges, and only the
    documents of that range are ordered. Limits are one row per source and length class.
    """
    new = ["size", "source_size", "target", "taken"]
    own = ["doc_id", "text", "source"]
    got = _mixed(wrapped(docs, *own), weights, share, most, seed)
    return got.select(*new, *unwrapped(docs, *own, without=new))


def _mixed(docs: DataFrame, weights: tuple[float, ...], share: float, most: int, seed: int) -> DataFrame:
    """The mix over ``doc_id, text, source`` and one column with all others."""
    at = "_key"
    keyed = docs.select(
        "*",
        n_words(F.col("text")).alias("size"),
        uniform(seed, F.col("doc_id"), F.col("text")).alias("_u"),
    )
    keyed = keyed.withColumn("_class", length_class(F.col("size")))
    narrow = stored(keyed.select("doc_id", "source", "size", "_u", "_class"), "mix-sizes")

    by_class = narrow.groupBy("source", "_class").agg(F.sum("size").alias("words"))
    by_class = stored(by_class, "mix-classes")
    sources = by_class.groupBy("source").agg(F.sum("words").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank % len(weights) + 1)
    everything = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    targets = filled(
        sources.withColumn("_weight", weight).withColumn("_all", everything),
        [], "source_size", "_weight", F.col("_all") * F.lit(share), most,
    ).select("source", "source_size", F.col("share").alias("target"))

    rates = by_class.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
    rates = rates.select("c.source", "_class", "words", "source_size", "target")
    rates = filled(
        rates.withColumn("_weight", class_weight(F.col("_class"))),
        ["source"], "words", "_weight", F.col("target"), most,
    )
    rate = F.least(F.try_divide("share", "words"), F.lit(float(most)))
    copies = F.coalesce(F.floor(rate + 1e-12), F.lit(0)).cast("int")
    chance = F.greatest(F.coalesce(rate, F.lit(0.0)) - F.col("copies"), F.lit(0.0))
    certain = F.sum(F.col("copies") * F.col("words")).over(Window.partitionBy("source"))
    rates = stored(
        rates.withColumn("copies", copies)
        .withColumn("chance", F.when(chance > 1e-9, chance).otherwise(0.0))
        .withColumn("left", F.col("target") - certain)
        .drop("_weight", "share"),
        "mix-rates",
    )

    # Random odds over inclusion odds, q, brought from (0, inf) to (0, 1) as q / (1 + q).
    over, under = F.col("_u") * (1 - F.col("chance")), (1 - F.col("_u")) * F.col("chance")
    rank_key = over / (over + under)
    ranked = narrow.transform(lambda d: with_rates(d, rates)).where("chance > 0")
    ranked = ranked.select("doc_id", "source", "size", "left", rank_key.alias(at))

    limits = rates.groupBy("source").agg(F.first("left").alias("left"))
    low, wide = F.lit(0.0), 1.0
    found = limits.select("source", "left", low.alias("low"))
    for _ in range(2):
        wide /= RANGES
        inside = with_limits(ranked.drop("left"), found, "source").where(
            (F.col(at) >= F.col("low")) & (F.col(at) < F.col("low") + F.lit(wide * RANGES))
        )
        place = F.least(F.floor((F.col(at) - F.col("low")) / F.lit(wide)), F.lit(RANGES - 1))
        sums = inside.groupBy("source", "left", "low", place.alias("_range")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("_range")
        sums = sums.withColumn("_sum", F.sum("words").over(order))
        # The first range whose words pass the limit; else the last that has any.
        reach = F.min_by(F.struct("_range", "words", "_sum"), F.struct(F.col("_sum") < F.col("left"), F.when(F.col("_sum") < F.col("left"), -F.col("_range")).otherwise(F.col("_range"))))
        hit = sums.groupBy("source", "left", "low").agg(reach.alias("_hit"))
        found = stored(
            hit.select(
                "source",
                (F.col("left") - F.col("_hit._sum") + F.col("_hit.words")).alias("left"),
                (F.col("low") + F.col("_hit._range") * F.lit(wide)).alias("low"),
            ),
            "mix-limits",
        )
    inside = with_limits(ranked.drop("left"), found, "source").where(
        (F.col(at) >= F.col("low")) & (F.col(at) < F.col("low") + F.lit(wide))
    )
    order = Window.partitionBy("source").orderBy(at, "doc_id", "size")
    # A document is taken if that brings the sum nearer to what is left.
    near = F.sum("size").over(order) - F.col("size") / 2 <= F.col("left")
    last = inside.withColumn("_near", near).where("_near").groupBy("source").agg(
        F.max(F.struct(F.col(at), F.col("doc_id"))).alias("_last")
    )
    limits = found.alias("f").join(last.alias("l"), F.col("f.source").eqNullSafe(F.col("l.source")), "left")
    limits = limits.select("f.source", "low", "_last")
    limits = stored(
        rates.alias("r").join(limits.alias("k"), F.col("r.source").eqNullSafe(F.col("k.source")), "left")
        .select("r.source", "_class", "source_size", "target", "copies", "chance", "low", "_last"),
        "mix-rules",
    )

    out = with_rates(keyed, limits)
    order = F.struct(rank_key.alias(at), F.col("doc_id").alias("doc_id"))
    taken = (F.col("chance") > 0) & (
        (rank_key < F.coalesce(F.col("low"), F.lit(0.0))) | F.coalesce(order <= F.col("_last"), F.lit(False))
    )
    copies = F.col("copies") + taken.cast("int")
    return out.select(
        F.col("size"),
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        (F.col("size") * copies).alias("taken"),
        *docs.columns,
    )


def with_limits(rows: DataFrame, limits: DataFrame, *keys: str) -> DataFrame:
    """Rows with the columns of ``limits`` of their keys, null keys matched too.

    ``limits`` was just stored, so Spark knows its size and sends it to all tasks only if
    it is below the session's broadcast threshold; else both sides are shuffled.
    """
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    extra = [F.col(f"b.{c}") for c in limits.columns if c not in keys]
    return rows.alias("a").join(limits.alias("b"), on, "left").select("a.*", *extra)


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    return with_limits(rows, rates.drop("words"), "source", "_class")


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, in the columns of ``docs``."""
    own = ["doc_id", "text", "source"]
    got = mixed(wrapped(docs, *own), **options)
    times = F.when(F.col("size") > 0, F.floor(F.try_divide("taken", "size")).cast("int")).otherwise(0)
    copies = got.where("taken > 0").select(*own, REST, F.explode(F.array_repeat(F.lit(0), times)).alias("copy"))
    return copies.select(*unwrapped(docs, *own))
