"""Merkle manifest of a table: leaves by row, a tree per source, one root; proofs of rows.

Every three consecutive nodes of a level (the last run may be shorter, even one) hash to a
node of the next level until one is left. Builders take aligned blocks of leaves and
append nodes to a log in the order in which they are complete (postorder). The place of
any node in such a log follows from the sizes of the subtrees before it, so proofs
address siblings by arithmetic and need no links between nodes.

A path of a leaf is text: for each level, from the leaf upwards, the digests of the run
with ``*`` for the own node; levels are separated by ``/``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.llm.common import stored

RUN = 3
#: Width of a digest as text.
DIGEST = 64
#: A builder's block holds ``RUN ** BLOCK_LEVELS`` leaves: 2,187, a log of 210 kB.
BLOCK_LEVELS = 7
SEGMENT = "tree long, block long, blocks long, n long, height int, first long, nodes string, root string"


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_over(n: int, most: int) -> int:
    """Levels above ``n`` leaves until one node is left, ``most`` at most."""
    height = 0
    while n > 1 and height < most:
        n, height = -(-n // RUN), height + 1
    return height


def postorder(leaves: list[str], height: int) -> list[str]:
    """All nodes of a tree of ``height`` levels over the leaves, in the order they are complete."""
    nodes: list[str] = []
    open_: list[list[str]] = [[] for _ in range(height + 1)]

    def append(level: int, digest: str) -> None:
        nodes.append(digest)
        if level < height:
            open_[level].append(digest)
            if len(open_[level]) == RUN:
                close(level)

    def close(level: int) -> None:
        run, open_[level] = "".join(open_[level]), []
        append(level + 1, hashed(run))

    for leaf in leaves:
        append(0, leaf)
    for level in range(height):
        if open_[level]:
            close(level)
    return nodes


def position(level: int, index: int, n: int, height: int) -> int:
    """Place in the postorder log of node ``index`` of ``level``, over ``n`` leaves.

    Up to its level, the nodes that its last leaf completes or that were complete before;
    above it, the nodes that end before its first leaf.
    """
    end = min((index + 1) * RUN**level, n)
    below = sum(-(-end // RUN**t) for t in range(level + 1))
    above = sum(index // RUN ** (t - level) for t in range(level + 1, height + 1))
    return below + above - 1


def run_of(nodes: str, level: int, index: int, n: int, height: int) -> str:
    """The run of a node with ``*`` in its place, by the places of its siblings."""
    first = index - index % RUN
    last = min(first + RUN, -(-n // RUN**level))
    out = []
    for i in range(first, last):
        at = position(level, i, n, height) * DIGEST
        out.append("*" if i == index else nodes[at : at + DIGEST])
    return "".join(out)


class Paths:
    """Paths of the leaves of one log, below the path of its root."""

    def __init__(self, nodes: str, n: int, height: int, upper: str):
        self.log = nodes, n, height
        self.height, self.upper = height, upper
        self.last: list[tuple[int, str]] = [(-1, "")] * height

    def __getitem__(self, index: int, level: int = 0) -> str:
        if level == self.height:
            return self.upper
        if self.last[level][0] != index:
            above = self.__getitem__(index // RUN, level + 1)
            nodes, n, height = self.log
            own = run_of(nodes, level, index, n, height)
            self.last[level] = index, f"{own}/{above}" if above else own
        return self.last[level][1]


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    levels = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.aggregate(levels, leaf, lambda cur, run: F.sha2(F.replace(run, F.lit("*"), cur), 256))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.translate(path, "*/", ""), 256)


def field(value: Column) -> Column:
    """A value with its size in bytes before it, ``-`` for null; no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column | str) -> Column:
    return F.sha2(F.concat(*[field(F.col(v) if isinstance(v, str) else v) for v in values]), 256)


def in_order(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``index`` in the order of their tree (nulls first) and its ``size``.

    Rows are range-sorted by (tree, order), so a large tree spans many tasks. Each task
    numbers its rows; a task's first index is the sum of the counts of those before it.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("part", T.LongType()), T.StructField("place", T.LongType())]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for value in batch.column(tree).to_pylist():
                if value != last:
                    last, place = value, 0
                places.append(place)
                place += 1
            more = [pa.array([part] * len(places), pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(number, schema)
    placed = stored(placed, "merkle-placed")
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy(tree, "part")
        .count()
        .withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .withColumn("size", F.sum("count").over(Window.partitionBy(tree)))
    )
    same = F.col(f"p.{tree}").eqNullSafe(F.col(f"b.{tree}")) & (F.col("p.part") == F.col("b.part"))
    return placed.alias("p").join(bases.alias("b"), same).select(
        *[F.col(f"p.{c}") for c in rows.columns], (F.col("base") + F.col("place")).alias("index"), "size"
    )


def log(rows: DataFrame, block_levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Logs of trees over ``tree, index, size, digest``: a table of segments per stage.

    The roots of a stage's blocks are the leaves of the next stage, until each tree has one
    block. A segment: block and number of blocks, leaves ``n``, ``height``, ``nodes`` in
    postorder, ``root`` (its last node), and ``first``, the place of its first node in the
    log of the stage's whole tree.
    """
    width = RUN**block_levels
    stages = []

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, leaves = None, 0, []

        def segment() -> pa.RecordBatch:
            tree, block = key
            height = levels_over(size, block_levels)
            nodes = postorder(leaves, height)
            whole = levels_over(size, 64)
            first = sum(block * width // RUN**t for t in range(whole + 1))
            row = (tree, block, -(-size // width), len(leaves), height, first, "".join(nodes), nodes[-1])
            types = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], names=[c.split()[0] for c in SEGMENT.split(", ")]
            )

        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("tree", "block", "size", "digest")]
            for tree, block, total, digest in zip(*lists):
                if (tree, block) != key:
                    if leaves:
                        yield segment()
                    key, size, leaves = (tree, block), total, []
                leaves.append(digest)
        if leaves:
            yield segment()

    rows = rows.select("tree", "index", "size", "digest")
    while True:
        blocks = rows.withColumn("block", F.floor(F.col("index") / width).cast("long"))
        blocks = blocks.repartition("tree", "block").sortWithinPartitions("tree", "index")
        stages.append(stored(blocks.mapInArrow(build, SEGMENT), "merkle-log"))
        rows = stages[-1].where("blocks > 1").select(
            "tree", F.col("block").alias("index"), F.col("blocks").alias("size"), F.col("root").alias("digest")
        )
        if not rows.limit(1).count():
            return stages


def roots(stages: list[DataFrame]) -> DataFrame:
    """``tree, root`` of each tree."""
    out = None
    for stage in stages:
        own = stage.where("blocks = 1").select("tree", "root")
        out = own if out is None else out.unionByName(own)
    return out


def paths(stages: list[DataFrame], tops: DataFrame, leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` (with ``tree, index``) with ``path`` and the other columns of ``tops``.

    ``tops`` has ``tree``, the ``path`` of its root, and columns to hand down. Logs are read
    from the last stage to the first; each gives its blocks' roots their paths. A task
    reads a block's log and then the leaves of that block.
    """
    width = RUN**block_levels
    handed = [c for c in tops.columns if c not in ("tree", "path")]
    upper = None
    for stage in reversed(stages):
        one, more = (
            stage.where(rule).select("tree", "block", "n", "height", "nodes") for rule in ("blocks = 1", "blocks > 1")
        )
        columns = ["tree", "block", "n", "height", "nodes", F.col("path").alias("upper"), *handed]
        logs = one.join(tops, "tree").select(columns)
        if upper is not None:
            below = upper.withColumnRenamed("index", "block")
            logs = logs.unionByName(more.join(below, ["tree", "block"]).select(columns))
        asked = leaves if stage is stages[0] else stages[stages.index(stage) - 1].where("blocks > 1").select(
            "tree", F.col("block").alias("index")
        )
        upper = _paths_of(logs, asked, handed, width)
        if stage is not stages[0]:
            upper = stored(upper, "merkle-paths")
    return upper


def _paths_of(logs: DataFrame, asked: DataFrame, handed: list[str], width: int) -> DataFrame:
    own = [c for c in asked.columns if c not in ("tree", "index")]
    asked = asked.withColumn("block", F.floor(F.col("index") / width).cast("long"))
    both = logs.withColumn("index", F.lit(-1).cast("long")).unionByName(asked, allowMissingColumns=True)
    both = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
    kinds = {f.name: f for f in both.schema.fields}
    schema = T.StructType([kinds[c] for c in ("tree", "index", *own)] + [T.StructField("path", T.StringType())])
    schema = T.StructType([*schema.fields, *[kinds[c] for c in handed]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, given = None, []
        for batch in batches:
            index = batch.column("index").to_pylist()
            keep, out, more = [], [], [[] for _ in handed]
            for row, i in enumerate(index):
                if i < 0:
                    nodes, n, height, top = (batch.column(c)[row].as_py() for c in ("nodes", "n", "height", "upper"))
                    found, given = Paths(nodes, n, height, top), [batch.column(c)[row].as_py() for c in handed]
                else:
                    keep.append(row)
                    out.append(found[i % width])
                    for values, value in zip(more, given):
                        values.append(value)
            if keep:
                rows = batch.select(["tree", "index", *own]).take(pa.array(keep))
                values = [pa.array(v, batch.schema.field(c).type) for v, c in zip(more, handed)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(out, pa.string()), *values], names=schema.names
                )

    return both.mapInArrow(task, schema)


def proofs(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` (``doc_id, source, leaf`` and more) with ``path``, ``subroot`` and ``root``.

    Leaves ascend by ``doc_id`` within a source (nulls first, ties by ``leaf``; repeated
    rows are a leaf each), sources ascend bytewise, null first. A source with one leaf has
    it as its subroot; so has one source its subroot as root. Empty texts and nulls are
    leaves like others. Without rows there is no result. Other columns come through as
    they are, except names of this job (``tree index size path subroot root``), which are
    replaced.
    """
    ours = ("tree", "index", "size", "path", "subroot", "root")
    kept = [c for c in leaves.columns if c not in ours]
    more = [c for c in kept if c not in ("doc_id", "source", "leaf")]
    rows = stored(
        leaves.select("doc_id", "source", "leaf", F.struct(F.lit(0), *more).alias("others")), "merkle-leaves"
    )
    sources = rows.select(F.lit(0).cast("long").alias("all"), "source").distinct()
    sources = stored(in_order(sources, "all", ["source"]), "merkle-sources")
    names = sources.select(F.col("source").alias("name"), F.col("index").alias("tree"), F.lit(True).alias("known"))
    placed = in_order(rows, "source", ["doc_id", "leaf"])
    placed = placed.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name", "known")
    placed = stored(placed, "merkle-rows")
    stages = log(placed.withColumnRenamed("leaf", "digest"), block_levels)
    subroots = stored(roots(stages), "merkle-subroots")
    count = sources.select(F.col("index").alias("tree"), "size")
    top_rows = subroots.join(count, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), "size", F.col("root").alias("digest")
    )
    top = log(top_rows, block_levels)
    whole = roots(top).select("tree", F.lit("").alias("path"), "root")
    tops = paths(top, whole, top_rows.select("tree", "index", F.col("digest").alias("subroot")), block_levels)
    tops = tops.select(F.col("index").alias("tree"), "path", "subroot", "root")
    found = paths(
        stages, stored(tops, "merkle-tops"), placed.select("tree", "index", "doc_id", "source", "leaf", "others"), block_levels
    )
    others = [F.col("others").getField(c).alias(c) for c in more]
    return found.select("doc_id", "source", "leaf", *others, "path", "subroot", "root")


def checked(suspects: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Proofs of rows, and whether the leaf that each claims leads to the root.

    ``suspects`` has ``doc_id, source, leaf`` and ``claimed``, the leaf as found later.
    """
    found = proofs(suspects, block_levels)
    again = found.withColumn("folded_root", folded(F.col("path"), F.col("claimed")))
    return again.select(
        "doc_id",
        "source",
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        F.coalesce(F.col("folded_root") == F.col("root"), F.lit(False)).alias("verified"),
    )
