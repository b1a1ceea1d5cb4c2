"""Exact top-k search by histogram selection.

Every query is scored against every vector in blocks, several times over; no list of
scores is kept. Each pass counts, per query, how many scores fall into each range of
scores, from the highest down to where k are reached. The range that holds the k-th score
is cut into ranges again until it is a single score. A last pass takes what is above that
score and, of its ties, as many as are missing, by smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.common import stored

#: A range of scores is cut into so many ranges in each pass.
CUTS = 4096
SCALE = 1024
#: Numbers in one block of vectors and of queries (rows times components).
V_BLOCK, Q_BLOCK = 1 << 18, 1 << 16
LONGEST = np.iinfo(np.int64).max
RESULT = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles, bounded to a long.

    Doubles are exact while the sums stay below 2 ** 53; longer ones are added up as
    Python integers.
    """
    width = max(1, queries.shape[1])
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * width
    if top < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(queries).astype(object) @ whole(vectors).astype(object).T
    return np.clip(exact, -LONGEST, LONGEST).astype(np.int64)


def pack(rows: DataFrame, side: str, block: Column) -> DataFrame:
    """One row per block: ids and components as binary, rows in order of id.

    ``block`` tells the rows of a block apart; blocks hold bounded numbers of rows.
    """
    kind = f"dim int, {side} long, {side}_ids binary, {side}_data binary"

    def task(key, table):
        table = table.sort_by("vec_id")
        dim, number = (k.as_py() for k in key)
        ids = np.asarray(table.column("vec_id").to_numpy(), "<i8")
        flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        data = np.floor(np.asarray(flat, "<f8") * SCALE)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                side: pa.array([number], pa.int64()),
                f"{side}_ids": pa.array([ids.tobytes()], pa.binary()),
                f"{side}_data": pa.array([data.tobytes()], pa.binary()),
            }
        )

    rows = rows.select("vec_id", "embedding", "dim", block.cast("long").alias("block"))
    return rows.groupBy("dim", "block").applyInArrow(task, kind)


def top_k(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best vectors of each query, exactly.

    ``vectors`` needs ``vec_id`` and ``embedding``; ``queries`` tells which of its rows
    are queries. Components become floor(1024 x); the score is the integer inner product.
    Ties go to the smaller id. A query is never its own candidate; with fewer than k
    candidates all are returned. Rows without id and vectors that are null or hold a null
    or a non-finite component take no part; vectors of another length than the query's
    are no candidates; empty vectors meet each other with score 0. Repeated rows of an id are candidates each and one query. Scores
    beyond a long stop at its ends. Without rows there is no result.

    Queries and vectors lie in blocks of bounded size, and each block of vectors meets
    each block of queries; tasks give out counts, then at most k rows for each query.
    Queries are never sent to all tasks at once nor to the driver.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        queries.alias("asks"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.withColumn("dim", F.size("embedding"))
    sizes = rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("asked")
    )
    sizes = stored(
        sizes.select(
            "dim",
            F.ceil(F.col("n") * F.greatest("dim", F.lit(1)) / V_BLOCK).alias("vs"),
            F.ceil(F.col("asked") * F.greatest("dim", F.lit(1)) / Q_BLOCK).alias("qs"),
        ).where("qs > 0"),
        "topk-sizes",
    )

    def block(of: str, *by: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(3), *by), F.greatest(F.col(of), F.lit(1)))

    sized = rows.withColumn("row", F.monotonically_increasing_id()).join(sizes, "dim")
    asking = sized.where("asks").dropDuplicates(["vec_id"])
    v_blocks = stored(pack(sized, "v", block("vs", F.col("row"))), "topk-vectors")
    q_blocks = stored(pack(asking, "q", block("qs", F.col("vec_id"))), "topk-queries")

    # Each block once for each block of the other side of its length.
    def others(blocks: DataFrame, name: str) -> DataFrame:
        numbers = F.sequence(F.lit(0), F.greatest(F.col(f"{name}s") - 1, F.lit(0)))
        wide = blocks.join(sizes, "dim").withColumn(name, F.explode(numbers))
        return wide.drop("vs", "qs")

    def pairs(asked: DataFrame) -> DataFrame:
        return others(asked, "v").join(others(v_blocks, "q"), ["dim", "q", "v"])

    ranges = stored(first_ranges(pairs(q_blocks), k), "topk-ranges")
    while (ranges.agg(F.max(F.col("high") - F.col("low"))).first()[0] or 0) > 0:
        ranges = stored(refined(pairs(with_ranges(q_blocks, ranges)), ranges), "topk-ranges")
    best = pairs(with_ranges(q_blocks, ranges)).mapInArrow(chosen, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def with_ranges(q_blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Blocks of queries with the ranges of their queries, in order of id."""
    own = F.sort_array(F.collect_list(F.struct("query_id", "low", "high", "missing")))
    lists = ranges.groupBy("dim", "q").agg(own.alias("ranges"))
    return q_blocks.join(lists, ["dim", "q"])


def scored(batches: Iterator[pa.RecordBatch]):
    """Row, ids of queries and vectors, scores and who may be chosen, for each pair of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            q_ids, v_ids = (np.frombuffer(row[f"{s}_ids"], "<i8") for s in "qv")
            q_data, v_data = (
                np.frombuffer(row[f"{s}_data"], "<f8").reshape(len(ids), row["dim"])
                for s, ids in (("q", q_ids), ("v", v_ids))
            )
            yield row, q_ids, v_ids, product(q_data, v_data), q_ids[:, None] != v_ids


def table_of(schema: list[tuple[str, pa.DataType]], columns: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in schema])


def first_ranges(pairs: DataFrame, k: int) -> DataFrame:
    """A range of scores that holds the k-th of each query.

    The k-th best of any block is a lower bound. With k candidates or fewer in all, the
    range is the lowest score.
    """
    names = ["dim", "q", "query_id", "least", "kth", "most", "n"]
    kinds = [("dim", pa.int32())] + [(n, pa.int64()) for n in names[1:]]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, q_ids, _, scores, allowed in scored(batches):
            columns = [[] for _ in names]
            for i, query in enumerate(q_ids.tolist()):
                own = scores[i][allowed[i]]
                if len(own):
                    kth = int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else None
                    line = (row["dim"], row["q"], query, int(own.min()), kth, int(own.max()), len(own))
                    for column, value in zip(columns, line):
                        column.append(value)
            yield table_of(kinds, columns)

    got = pairs.mapInArrow(task, "dim int, " + ", ".join(f"{n} long" for n in names[1:]))
    got = got.groupBy("dim", "q", "query_id").agg(
        F.min("least").alias("least"), F.max("kth").alias("kth"), F.max("most").alias("most"), F.sum("n").alias("n")
    )
    few = F.col("n") <= k
    return got.select(
        "dim",
        "q",
        "query_id",
        F.when(few, F.col("least")).otherwise(F.coalesce("kth", "least")).alias("low"),
        F.when(few, F.col("least")).otherwise(F.col("most")).alias("high"),
        F.lit(k).cast("long").alias("missing"),
    )


def refined(pairs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ranges 4096 times as narrow, with what is missing in them."""
    kinds = [("dim", pa.int32()), ("q", pa.int64()), ("query_id", pa.int64()), ("cut", pa.int64()), ("n", pa.int64())]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, q_ids, _, scores, allowed in scored(batches):
            columns = [[] for _ in kinds]
            for i, r in enumerate(row["ranges"]):
                width = (r["high"] - r["low"]) // CUTS + 1
                own = scores[i][allowed[i] & (scores[i] >= r["low"]) & (scores[i] <= r["high"])]
                cuts, counts = np.unique((own - r["low"]) // width, return_counts=True)
                cuts, counts = cuts[::-1], counts[::-1]
                # Below the range where this block alone reaches what is missing, none counts.
                last = int(np.searchsorted(np.cumsum(counts), r["missing"])) + 1
                for cut, n in zip(cuts[:last].tolist(), counts[:last].tolist()):
                    for column, value in zip(columns, (row["dim"], row["q"], r["query_id"], cut, n)):
                        column.append(value)
            yield table_of(kinds, columns)

    counts = pairs.mapInArrow(task, "dim int, q long, query_id long, cut long, n long")
    counts = counts.groupBy("dim", "q", "query_id", "cut").agg(F.sum("n").alias("n"))
    keys = ["dim", "q", "query_id"]
    down = Window.partitionBy(*keys).orderBy(F.col("cut").desc())
    reached = counts.withColumn("upto", F.sum("n").over(down)).join(ranges, keys)
    hit = reached.where("upto >= missing and upto - n < missing")
    width = F.floor((F.col("high") - F.col("low")) / CUTS) + 1
    low = F.col("low") + F.col("cut") * width
    return hit.select(
        *keys,
        low.alias("low"),
        F.least(F.col("high"), low + width - 1).alias("high"),
        (F.col("missing") - F.col("upto") + F.col("n")).alias("missing"),
    ).unionByName(  # queries with too few candidates keep their range
        ranges.join(hit.select(*keys), keys, "left_anti")
    )


def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates above the k-th score, and of those at it the smallest ids that are missing."""
    kinds = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
    for row, q_ids, v_ids, scores, allowed in scored(batches):
        parts = [[] for _ in kinds]
        for i, r in enumerate(row["ranges"]):
            above = np.flatnonzero(allowed[i] & (scores[i] > r["low"]))
            # Ids of a block rise, so the first ties are the smallest.
            ties = np.flatnonzero(allowed[i] & (scores[i] == r["low"]))[: r["missing"]]
            found = np.concatenate([above, ties])
            for part, values in zip(parts, (np.full(len(found), r["query_id"]), v_ids[found], scores[i][found])):
                part.append(values)
        if parts[0]:
            yield table_of(kinds, [np.concatenate(p) for p in parts])
