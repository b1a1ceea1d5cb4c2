"""Near-duplicates by BagMinHash signatures of five-word shingles, with verification.

A text is the multiset of its shingles; two texts are linked if the weighted Jaccard
similarity of their multisets (sum of smaller over sum of larger counts) is 0.8 or more.
Classes are the connected parts of the links and of equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import Remembered, in_chunks, kept, stored, texts, unwrapped, wrapped

SHINGLE = 5
SIMILARITY = 0.8
#: 20 bands of 6 components: a pair at 0.8 shares a band with probability 0.998.
BANDS, ROWS = 20, 6
#: Components keep four bits each in a sketch of so many 64-bit numbers; a pair at 0.8
#: differs in at most so many components with probability 0.998.
SKETCH, MOST_DIFFERENT = 8, 36
#: Bands that the first round of comparisons looks at.
FIRST_BANDS = 3
#: In each later round a bucket has so many times as many leaders.
GROWTH = 8
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def word_hashes() -> Remembered:
    """Hash of each distinct word."""
    import xxhash

    return Remembered(xxhash.xxh64_intdigest, 48 << 20)


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the runs of five words; fewer words are one run, none are none."""
    found = text.split()
    hashes = kept(("dedup-words",), word_hashes)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    size = min(SHINGLE, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * _ODD[i] + h[i : len(h) - size + 1 + i])
    return out


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(text), return_counts=True)


def occurrences(text: bytes) -> np.ndarray:
    """The multiset as a set: one number for the i-th occurrence of each shingle.

    The overlap of two such sets is the overlap of the multisets.
    """
    elements, counts = bag(text)
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    turn = (np.arange(len(starts)) - starts).astype(np.uint64)
    return mix(np.repeat(elements, counts) + turn * _ODD[3])


def signatures(elements: np.ndarray, counts: np.ndarray, owners: np.ndarray, docs: int) -> np.ndarray:
    """BagMinHash signatures of ``docs`` multisets, each of at least one element.

    Counts are the levels of a weight, grouped into strips (0, 1], (1, 2], (2, 4], (4, 8],
    ... A strip of an element holds one Poisson process over all components, with a rate
    of one per level and component; the bits of a point's random number send it down the
    halves of the strip to a level, and it counts where the weight reaches that level.
    A document sees the points of its elements up to its weights, so two documents share
    the first point of a component with the probability of their weighted Jaccard
    similarity. Points are drawn in rising time up to a limit that fills a signature
    with high probability; where one stays open, its document starts again with twice
    the limit.
    """
    m = BANDS * ROWS
    out = np.zeros((docs, m), np.uint64)
    weights = np.bincount(owners, weights=counts, minlength=docs)
    limits = (np.log(m) + 3) / np.maximum(weights, 1)
    open_ = np.ones(docs, bool)
    while open_.any():
        use = open_[owners]
        e, w, o = elements[use], counts[use], owners[use]
        slots, times, names = [], [], []
        low, width, strip = 0, 1, 0
        while True:
            has = w > low
            if not has.any():
                break
            ee, ww, oo = e[has], w[has], o[has]
            t, turn = np.zeros(len(ee)), 0
            while len(ee):
                start = (strip << 40 | turn) * int(_ODD[0]) & (1 << 64) - 1
                r = mix(ee ^ mix(np.array([start], np.uint64)))
                t = t - np.log(((r >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / (m * width)
                keep = t <= limits[oo]
                ee, ww, oo, t, r = ee[keep], ww[keep], oo[keep], t[keep], r[keep]
                r = mix(r + _ODD[4])
                component = ((r >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
                level = low + 1 + (mix(r) & np.uint64(width - 1)).astype(np.int64)
                seen = level <= ww
                slots.append(oo[seen] * m + component[seen].astype(np.int64))
                times.append(t[seen])
                names.append(r[seen])
                turn += 1
            low, width, strip = low + width, max(1, low + width), strip + 1
        slot, time, name = (np.concatenate(x) for x in (slots, times, names))
        best = np.full(docs * m, np.inf)
        np.minimum.at(best, slot, time)
        first = time == best[slot]
        out.reshape(-1)[slot[first]] = name[first]
        open_ &= ~np.isfinite(best.reshape(docs, m)).all(axis=1)
        limits[open_] *= 2
    return out


def buckets(signature: np.ndarray) -> np.ndarray:
    """One number per band from its components and its place."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        out = mix(out * _ODD[3] + parts[:, :, i])
    return out


def sketches(signature: np.ndarray) -> np.ndarray:
    """Four bits of each component, sixteen components to a number."""
    nibbles = np.zeros((len(signature), SKETCH * 16), np.uint64)
    nibbles[:, : BANDS * ROWS] = mix(signature) & np.uint64(15)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(nibbles.reshape(-1, SKETCH, 16) << shifts, axis=2)


def alike(sketch: str, other: str) -> Column:
    """Whether few enough components of two sketches differ for enough similarity.

    Equal components have equal bits, others do with a chance of one in sixteen.
    """
    ones = F.lit(0x1111111111111111)
    different = F.lit(0)
    for i in range(SKETCH):
        x = F.get(sketch, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        different = different + F.bit_count(x.bitwiseAND(ones))
    return different <= MOST_DIFFERENT


def digest(text: Column) -> Column:
    """Equal texts have equal digests; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, n`` (shingles), ``bands`` and ``sketch`` (null without words) of non-null texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", 4 << 20):
            bags = [bag(t) for t in texts(batch, "text")]
            full = [i for i, (e, _) in enumerate(bags) if len(e)]
            bands = [None] * len(bags)
            sketch = [None] * len(bags)
            if full:
                owners = np.repeat(np.arange(len(full)), [len(bags[i][0]) for i in full])
                elements, counts = (np.concatenate([bags[i][k] for i in full]) for k in (0, 1))
                found = signatures(elements, counts, owners, len(full))
                for i, band, few in zip(full, buckets(found).view(np.int64), sketches(found).view(np.int64)):
                    bands[i], sketch[i] = band, few
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketch, pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "n", "bands", "sketch"],
            )

    rows = docs.where(F.col("text").isNotNull()).select("doc_id", digest(F.col("text")).alias("digest"), "text")
    return rows.mapInArrow(task, "doc_id long, digest binary, n long, bands array<bigint>, sketch array<bigint>")


def shingled(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``digest, elements`` of the texts with wanted digests."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", 4 << 20):
            sets = [occurrences(t).view(np.int64) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(sets, pa.list_(pa.int64()))], names=["digest", "elements"]
            )

    rows = docs.join(wanted, ["doc_id", "digest"], "left_semi").select("digest", "text")
    return rows.mapInArrow(task, "digest binary, elements array<bigint>").dropDuplicates(["digest"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose multisets are similar enough."""
    left = sets.select(F.col("digest").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("digest").alias("b"), F.col("elements").alias("of_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.where(common / union >= SIMILARITY).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node, part``: the smallest node of each connected part, for nodes with edges.

    Every node takes the smallest label among its neighbours and then its label's label,
    until nothing changes; each step is a stored table.
    """
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).distinct(), "dedup-edges"
    )
    parts = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("part"))
    parts = stored(parts.withColumn("changed", F.lit(True)), "dedup-parts")
    while parts.where("changed").limit(1).count():
        label = parts.select(F.col("node").alias("b"), "part")
        near = both.join(label, "b").groupBy(F.col("a").alias("node")).agg(F.min("part").alias("near"))
        step = parts.join(near, "node").select("node", F.col("part").alias("old"), F.least("part", "near").alias("part"))
        step = stored(step, "dedup-step")
        root = step.select(F.col("node").alias("part"), F.col("part").alias("root"))
        parts = stored(
            step.join(root, "part").select(
                "node", F.least("part", "root").alias("part"), (F.least("part", "root") != F.col("old")).alias("changed")
            ),
            "dedup-parts",
        )
    return parts.select("node", "part")


def possible(n: Column, other_n: Column, most: Column | None = None, other_most: Column | None = None) -> Column:
    """Whether sizes allow enough similarity.

    ``most`` is how many elements of a node can be common at all.
    """
    common = F.least(n if most is None else most, other_n if other_most is None else other_most)
    return common >= SIMILARITY * (n + other_n - common) - 1e-9


def still_open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members, with their parts, of the buckets that hold several parts."""
    own = parts.select(F.col("node").alias("digest"), "part")
    placed = members.join(own, "digest", "left").select(
        "bucket", "band", "digest", "n", F.coalesce("part", "digest").alias("part")
    )
    split = placed.groupBy("bucket").agg(
        F.min("part").alias("least"), F.max("part").alias("most"), F.count("*").alias("size")
    ).where("least <> most")
    split = stored(split.select("bucket", "size"), "dedup-split")
    return stored(placed.join(split, "bucket"), "dedup-open")


def own_elements(sets: DataFrame, open_: DataFrame) -> DataFrame:
    """``digest, own``: elements of a node that no open node of another part has.

    A node's links to other parts can share the rest of its elements only.
    """
    placed = open_.select("digest", "part").distinct()
    elements = sets.join(placed, "digest").select("digest", "part", F.explode("elements").alias("element"))
    single = (
        elements.groupBy("element")
        .agg(F.min("part").alias("least"), F.max("part").alias("most"))
        .where("least = most")
        .select("element")
    )
    return elements.join(single, "element", "left_semi").groupBy("digest").agg(F.count("*").alias("own"))


def joined_parts(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Parts after new links; parts are joined by links between their smallest nodes."""
    for side in "ab":
        own = parts.select(F.col("node").alias(side), F.col("part").alias(f"{side}_part"))
        links = links.join(own, side, "left")
    lifted = links.select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b"))
    joined = components(lifted.where("a <> b").distinct())
    grown = joined.select(F.col("node").alias("part"), F.col("part").alias("new"))
    alone = joined.join(parts, "node", "left_anti")
    parts = parts.join(grown, "part", "left").select("node", F.coalesce("new", "part").alias("part"))
    return stored(parts.unionByName(alone).distinct(), "dedup-parts")


def near_classes(docs: DataFrame) -> DataFrame:
    """``digest, first_id, class_id, head`` (the class's text) of all different texts (non-null).

    Equal texts are one node. Nodes that share a band meet in a bucket. A bucket's first
    node is compared with the others, over a few bands first, and then its most central
    node, so that large groups of copies become one part at linear cost. Then, in buckets
    that still hold several parts, growing samples of nodes (eight times as many in each
    round, at last all) are compared with the nodes of other parts. What is in one part
    already is never compared, nor a pair whose elements that only their parts have
    rule out enough similarity, nor one whose signatures differ too often for it; no other
    pair of a bucket is left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_text = signed(docs).groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")]
    )
    nodes = stored(by_text, "dedup-nodes")
    members = nodes.select(
        F.struct("first_id", "digest").alias("node"), "n", F.posexplode("bands").alias("band", "bucket")
    )
    # Only buckets of two nodes or more go on.
    shared = members.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.count("*").alias("size")
    ).where("size > 1")
    shared = stored(shared, "dedup-buckets")
    members = stored(
        members.join(shared, "bucket").select(
            "bucket", "band", "size", "n", F.col("node.digest").alias("digest"),
            F.col("node.first_id").alias("first_id"), F.col("leader.digest").alias("leader"),
        ),
        "dedup-members",
    )
    wanted = members.select(F.col("first_id").alias("doc_id"), "digest").distinct()
    with_digest = docs.where(F.col("text").isNotNull()).withColumn("digest", digest(F.col("text")))
    with_digest = with_digest.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1).cast("long")))
    wanted = wanted.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1).cast("long")))
    sets = stored(shingled(with_digest, wanted), "dedup-sets")

    def pair(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    # First round: every node against the first of its bucket, in a few bands.
    sizes = members.select(F.col("digest").alias("leader"), F.col("n").alias("leader_n")).distinct()
    first = members.where((F.col("band") < FIRST_BANDS) & (F.col("leader") != F.col("digest")))
    first = first.select("leader", "digest", "n").distinct().join(sizes, "leader")
    close = possible(F.col("n"), F.col("leader_n"))
    tested = stored(first.where(close).select(*pair("leader", "digest")).distinct(), "dedup-pairs")
    parts = components(stored(verified(tested, sets), "dedup-links"))

    open_ = still_open(members, parts)
    bands = nodes.join(open_.select("digest").distinct(), "digest", "left_semi").select("digest", "bands", "sketch")
    bands = stored(bands, "dedup-bands")
    # Second round: every node against the one of its bucket with the fewest elements of
    # its own part. Then samples of a size that grows, at last all.
    share = None
    while open_.limit(1).count():
        largest = open_.agg(F.max("size")).first()[0]
        own = stored(own_elements(sets, open_), "dedup-own")
        nodes_of = open_.join(own, "digest", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0)))
        nodes_of = nodes_of.join(bands, "digest").select("bucket", "band", "digest", "n", "most", "part", "bands", "sketch")
        if share is None:
            best = F.min_by(F.struct("digest", "n", "most", "part", "bands", "sketch"), F.struct(1 - F.col("most") / F.col("n"), "digest"))
            leads = nodes_of.groupBy("bucket").agg(best.alias("o")).select("bucket", "o.*")
            share, once = GROWTH, F.lit(True)
            while share < largest:
                share *= GROWTH
        else:
            share = max(1, share // GROWTH)
            while share > 1 and share // GROWTH >= largest:
                share //= GROWTH
            leads = nodes_of.where(F.pmod(F.xxhash64("bucket", "digest"), F.lit(share)) == 0)
            # A pair of several buckets is met in that of its first common band.
            same = F.zip_with("bands", "other_bands", lambda x, y: x == y)
            once = F.array_position(same, F.lit(True)) == F.col("band") + 1
        leads = stored(
            leads.select("bucket", *[F.col(c).alias(f"other_{c}") for c in ("digest", "n", "most", "part", "bands", "sketch")]),
            "dedup-leads",
        )
        met = nodes_of.join(leads, "bucket").where(
            (F.col("part") != F.col("other_part"))
            & ((F.lit(share) > 1) | (F.col("digest") < F.col("other_digest")))
            & possible(F.col("n"), F.col("other_n"), F.col("most"), F.col("other_most"))
            & once
            & alike("sketch", "other_sketch")
        )
        fresh = met.select(*pair("digest", "other_digest")).distinct().join(tested, ["a", "b"], "left_anti")
        fresh = stored(fresh, "dedup-pairs")
        links = stored(verified(fresh, sets), "dedup-links")
        tested = stored(tested.unionByName(fresh), "dedup-tested")
        if links.limit(1).count():
            parts = joined_parts(parts, links)
        if share == 1:
            break
        open_ = still_open(members, parts)
    own = parts.select(F.col("node").alias("digest"), "part")
    classed = nodes.select("digest", "first_id").join(own, "digest", "left")
    classed = classed.withColumn("part", F.coalesce("part", "digest"))
    # The smallest id; a text without ids is head only where all are.
    first = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "digest")
    heads = classed.groupBy("part").agg(F.min(first).alias("head"))
    return stored(
        classed.join(heads, "part").select(
            "digest", "first_id", F.col("head.first_id").alias("class_id"), F.col("head.digest").alias("head")
        ),
        "dedup-classes",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id``: each document with the smallest id of its class.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Equal texts are in
    one class, also empty ones; a null text is a class of its own. Texts of fewer than five
    words are one shingle; texts without words are like equal texts only. Repeated rows
    are returned each. A class of rows without ids has a null id. Without rows there is no
    result. Words are runs of anything but ASCII white space, compared as they are.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
    classes = near_classes(docs).select("digest", "class_id", F.lit(True).alias("known"))
    joined = own.join(classes, "digest", "left")
    return joined.select("doc_id", F.when(F.col("known"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the text that has its smallest id.

    Null texts all stay. Copies of a text under its smallest id (repeated rows) are told
    apart by nothing, so one of them stays.
    """
    classes = near_classes(docs)
    heads = classes.where(F.col("digest") == F.col("head")).select(F.col("digest").alias("_digest"), F.col("first_id").alias("_first"))
    own = ("doc_id", "text")
    keyed = wrapped(docs, *own).withColumn("_digest", digest(F.col("text")))
    counts = keyed.select("_digest", F.col("doc_id").cast("long").alias("_first")).groupBy("_digest", "_first").count()
    repeated = counts.where("count > 1").select("_digest", "_first").withColumn("_again", F.lit(True))
    same = F.col("k._digest").eqNullSafe(F.col("h._digest")) & F.col("k._first").eqNullSafe(F.col("h._first"))
    heads = heads.alias("h").join(repeated.alias("k"), same, "left").select("h.*", F.coalesce("_again", F.lit(False)).alias("_again"))
    heads = stored(heads, "dedup-heads")
    found = keyed.alias("d").join(
        heads.alias("h"),
        (F.col("d._digest") == F.col("h._digest")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("h._first")),
        "left",
    ).select("d.*", F.col("h._digest").alias("_head"), "_again")
    alone = found.where((F.col("_head").isNotNull() & ~F.col("_again")) | F.col("_digest").isNull())
    again = found.where(F.col("_again")).dropDuplicates(["_digest"])
    return alone.unionByName(again).select(*unwrapped(docs, *own))
