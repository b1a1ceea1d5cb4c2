"""Quality rules by distribution divergence, with built-in functions only.

A document's histogram of character classes and its histogram of common words are
compared with those of its language by Jensen-Shannon distance. The references are sums
over all documents of the language, or over all documents where the language is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.common import stored, words
from evalspark.operators.columns import with_computed

#: Fixed rules of the base check.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
SPACES = r"[\x20\x09-\x0D]"
#: Character classes by pattern; what none matches is the last class.
CLASSES = (r"\p{Lu}", r"\p{N}", SPACES, "[.,;:!?]", r"[#*$%&|<>=_/@^~+\\-]")
#: Distances above these fail, once a text is long enough for its histogram.
MOST_CHARS_DISTANCE = 0.30
MOST_WORDS_DISTANCE = 0.5
LEAST_CHARS = 200
LEAST_WORDS_FOR_WORDS = 100
#: Common words: so many of each language, of any length. Those of at most so many
#: characters are counted one by one, longer ones first by the bins of their hashes.
COMMON = 16
COMMON_CHARS = 4
BINS = 1 << 16
WINDOWS = "array<struct<hash:bigint,place:int>>"


def window_hashes(w: Column) -> Column:
    """Hashes of the 3-word windows, in their order."""
    at = F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0)))
    hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) >= 3, hashes).otherwise(F.array().cast("array<bigint>"))


def windows(hashes: Column) -> Column:
    """Windows sorted by hash and place; none where all hashes differ."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeated, F.sort_array(placed)).otherwise(F.array().cast(WINDOWS))


def repeated_places(w: Column, ordered: Column) -> Column:
    """Places, rising, of windows that occur twice or more.

    Equal windows are neighbours in the order; those whose hashes agree are compared word
    by word.
    """

    def same(a: Column, b: Column) -> Column:
        i, j = a["place"], b["place"]
        equal = F.get(w, i) == F.get(w, j)
        for k in (1, 2):
            equal = equal & (F.get(w, i + k) == F.get(w, j + k))
        return F.when(a["hash"] == b["hash"], equal).otherwise(False)

    found = F.filter(
        ordered, lambda x, i: same(x, F.get(ordered, i + 1)) | same(x, F.get(ordered, i - 1))
    )
    return F.sort_array(F.transform(found, lambda x: x["place"]))


def covered(places: Column) -> Column:
    """Words under the windows at these places: each adds those that the one before left."""
    gaps = F.transform(
        places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3))
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)


def class_counts(text: Column) -> Column:
    found = [F.regexp_count(text, F.lit(c)).cast("long") for c in CLASSES]
    rest = F.length(text).cast("long")
    for f in found:
        rest = rest - f
    return F.array(*found, rest)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts; null without counts."""

    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
        return F.transform(counts, lambda x: F.try_divide(x.cast("double"), total.cast("double")))

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.when(x == 0, 0.0))

    terms = F.zip_with(shares(p), shares(q), lambda x, y: (part(x, y) + part(y, x)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), total))


def most(counts: DataFrame) -> DataFrame:
    """The ``COMMON`` words (lang, key, n) with most occurrences of each language, placed."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("key")))
    return counts.withColumn("place", place).where(F.col("place") <= COMMON)


def common_words(docs: DataFrame) -> DataFrame:
    """The common words of each language, null for all documents: ``lang, place, key, n``.

    All words count, but the rare long ones are never told apart: a long word is no more
    frequent than its bin, so only bins that reach the last of the common short words are
    counted word by word, in a second reading. Mostly there are none.
    """
    spoken = docs.select("lang", F.explode(words(F.col("text"))).alias("x"))
    spoken = spoken.select("lang", F.lower("x").alias("word"))
    short = F.length("word") <= COMMON_CHARS
    bin_of = F.pmod(F.xxhash64("word"), F.lit(BINS)).cast("int")
    found = spoken.groupBy(
        "lang", F.when(short, F.col("word")).alias("key"), F.when(~short, bin_of).alias("bin")
    ).agg(F.count("*").alias("n"))
    found = stored(found, "quality-words")
    nobody = F.lit(None).cast("string").alias("lang")
    every = found.groupBy("key", "bin").agg(F.sum("n").alias("n")).select(nobody, "key", "bin", "n")
    found = found.where("lang is not null").unionByName(every)
    known = found.where("bin is null").select("lang", "key", "n")
    first = most(known)
    last = first.where(F.col("place") == COMMON).select("lang", F.col("n").alias("least"))
    reach = found.where("bin is not null").alias("b").join(
        last.alias("l"), F.col("b.lang").eqNullSafe(F.col("l.lang")), "left"
    )
    reach = reach.where(F.col("n") >= F.coalesce("least", F.lit(0)))
    reach = stored(reach.select("b.lang", "bin"), "quality-bins")
    if reach.isEmpty():
        return first
    long_words = spoken.where(~short).withColumn("bin", bin_of).alias("s")
    own = F.col("h.lang").isNull() | (F.col("h.lang") == F.col("s.lang"))
    met = long_words.join(reach.alias("h"), (F.col("s.bin") == F.col("h.bin")) & own)
    counted = met.groupBy("h.lang", F.col("word").alias("key")).agg(F.count("*").alias("n"))
    return most(known.unionByName(counted))


def references(base: DataFrame, common: DataFrame) -> DataFrame:
    """One row per language, null for all documents: ``ref_classes, ref_counts``.

    ``ref_counts`` has the occurrences of the common words and that of all other words.
    ``base`` has ``lang, n_words, classes``, ``common`` has ``lang, ref_n``. Counts are
    summed before the shuffle, so a language with most documents is no hot key.
    """
    n_classes = len(CLASSES) + 1
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(n_classes)]
    totals = base.groupBy("lang").agg(*sums, F.sum("n_words").alias("n"))
    again = [F.sum(c).alias(c) for c in (*(f"c{i}" for i in range(n_classes)), "n")]
    nobody = F.lit(None).cast("string").alias("lang")
    totals = totals.where("lang is not null").unionByName(totals.agg(*again).select(nobody, "*"))
    both = totals.alias("t").join(common.alias("m"), F.col("t.lang").eqNullSafe(F.col("m.lang")), "left")
    both = both.select("t.*", F.coalesce("ref_n", F.array().cast("array<bigint>")).alias("ref_n"))
    known = F.aggregate("ref_n", F.lit(0).cast("long"), lambda s, n: s + n)
    return stored(
        both.select(
            "lang",
            F.array(*[F.col(f"c{i}") for i in range(n_classes)]).alias("ref_classes"),
            F.concat("ref_n", F.array(F.col("n") - known)).alias("ref_counts"),
        ),
        "quality-references",
    )


def quality(docs: DataFrame) -> DataFrame:
    """Base counts, distances and verdict of each document, ``kept`` where it passes.

    ``docs`` needs ``doc_id, text, lang``; other columns are not read. Null and empty
    texts have no words, fail the base check and have null distances. Repeated rows are
    judged each on its own and count each in the references. Without rows there is no
    result. A text is one row: its windows are sorted within the row, never exploded.

    A document fails the base check with fewer than 50 words, or if more than half of its
    words lie in repeated 3-word windows. From 200 characters on the distance of its
    character classes counts, from 100 words on that of its common words.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text")
    )
    some = F.filter(
        F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, SPACES + "+", "")) > 0
    )
    listed = common_words(source).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("place", "key", "n"))).alias("c")
    )
    listed = listed.select("lang", F.col("c.key").alias("ref_words"), F.col("c.n").alias("ref_n"))
    common = stored(listed, "quality-common")
    # A row per language, stored just now: Spark sends it to all tasks as its size allows.
    met = source.alias("d").join(common.alias("r"), F.col("d.lang").eqNullSafe(F.col("r.lang")), "left")
    met = met.select("d.*", F.coalesce("ref_words", F.array().cast("array<string>")).alias("ref_words"))
    longest = F.coalesce(F.array_max(F.transform("ref_words", lambda x: F.length(x))), F.lit(0))
    with_words = with_computed(met, w=words(F.col("text")), lines=some, longest=longest)
    hashed = with_computed(with_words, hashes=window_hashes(F.col("w")))
    ordered = with_computed(
        hashed,
        ordered=windows(F.col("hashes")),
        common=F.filter(
            F.transform("w", lambda x: F.lower(x)),
            lambda x: (F.length(x) <= F.col("longest")) & F.array_contains("ref_words", x),
        ),
    )
    places = with_computed(ordered, places=repeated_places(F.col("w"), F.col("ordered")))
    n_words = F.size("w").cast("long")
    counts = F.concat(
        F.transform("ref_words", lambda r: F.size(F.filter("common", lambda x: x == r)).cast("long")),
        F.array(n_words - F.size("common")),
    )
    base = with_computed(
        places,
        n_words=n_words,
        word_chars=F.length(F.array_join("w", "")).cast("long"),
        n_symbols=F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=covered(F.col("places")),
        classes=class_counts(F.col("text")),
        counts=counts,
    )
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "counts")
    base = stored(base.select("doc_id", "lang", *made), "quality-base")
    refs = references(base, common)
    histograms = base.alias("d").join(refs.alias("r"), F.col("d.lang").eqNullSafe(F.col("r.lang")), "left")
    histograms = histograms.select("d.*", "ref_classes", "ref_counts")
    n_chars = F.aggregate("classes", F.lit(0).cast("long"), lambda s, x: s + x)
    judged = with_computed(
        histograms,
        js_chars=F.round(js_distance(F.col("classes"), F.col("ref_classes")), 6),
        js_words=F.round(js_distance(F.col("counts"), F.col("ref_counts")), 6),
        total=n_chars,
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    far = ((F.col("total") >= LEAST_CHARS) & (F.col("js_chars") > MOST_CHARS_DISTANCE)) | (
        (F.col("n_words") >= LEAST_WORDS_FOR_WORDS) & (F.col("js_words") > MOST_WORDS_DISTANCE)
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"),
        "js_chars",
        "js_words",
    )
