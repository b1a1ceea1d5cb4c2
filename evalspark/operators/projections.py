"""Approximate nearest vectors: buckets of signed random projections, exact re-ranking.

A vector's signs against random planes name its bucket in each of several tables. A query
looks into its own bucket and into those that differ in its least certain signs; what it
meets there is compared exactly. So an answer's similarities are exact, and only which
vectors are met is left to chance: :func:`recall` measures that against the exact job.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from evalspark.operators import similarity
from evalspark.operators.similarity import usable

TABLES, BITS, PROBES, SEED = 10, 8, 24, 11
#: Tables have numbers below this.
MOST_TABLES = 1 << 12


def planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    """The same planes wherever they are drawn, for each length of vectors its own."""
    return np.random.default_rng([seed, dim]).normal(size=(dim, tables * bits))


def _sides(frame: pd.DataFrame, tables: int, bits: int, seed: int) -> Iterator[tuple[pd.Series, np.ndarray]]:
    """Ids and projections (rows, tables, bits) of the vectors of each length."""
    for dim, own in frame.groupby(frame["vector"].map(len)):
        stacked = np.stack(own["vector"].to_numpy()).astype(float).reshape(len(own), dim)
        yield own.iloc[:, 0], (stacked @ planes(dim, tables, bits, seed)).reshape(len(own), tables, bits)


def _rows(ids: pd.Series, name: str, dim: int, buckets: np.ndarray) -> pd.DataFrame:
    """One row per id, table and bucket; ``buckets`` is (rows, tables, probes)."""
    count, tables, probes = buckets.shape
    return pd.DataFrame(
        {
            name: np.repeat(ids.to_numpy(), tables * probes),
            "dim": dim,
            "table": np.tile(np.repeat(np.arange(tables), probes), count),
            "bucket": buckets.reshape(-1),
        }
    )


def _schema(df: DataFrame, name: str) -> T.StructType:
    kinds = [("dim", T.IntegerType()), ("table", T.IntegerType()), ("bucket", T.LongType())]
    return T.StructType([T.StructField(name, df.schema[name].dataType), *[T.StructField(n, k) for n, k in kinds]])


def _vectors(df: DataFrame, name: str) -> DataFrame:
    wide = df.select(name, F.col("vector").cast("array<double>").alias("vector"))
    return wide.where(usable(F.col("vector")) & (F.size("vector") > 0))


def projection_index(
    docs: DataFrame, tables: int = TABLES, bits: int = BITS, seed: int = SEED
) -> DataFrame:
    """(doc_id, vector) -> (doc_id, dim, table, bucket), one row per vector and table.

    Every vector is in every table; nothing is fitted. With N vectors, about log2(N) bits
    keep buckets small. Vectors that are null, empty or hold a null or non-finite component
    take no part.
    """
    weights = 1 << np.arange(bits)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, sides in _sides(frame, tables, bits, seed):
                dim = len(frame.loc[ids.index[0], "vector"])
                yield _rows(ids, "doc_id", dim, ((sides > 0) @ weights)[:, :, None])

    return _vectors(docs, "doc_id").mapInPandas(task, _schema(docs, "doc_id"))


def probed_buckets(
    queries: DataFrame, tables: int = TABLES, bits: int = BITS, probes: int = PROBES, seed: int = SEED
) -> DataFrame:
    """(query_id, vector) -> (query_id, dim, table, bucket): the buckets a query looks into.

    Up to three signs are turned; those sets of signs come first whose distances from
    their planes have the smallest sum of squares.
    """
    turned = [c for size in range(4) for c in combinations(range(bits), size)]
    chosen = np.zeros((len(turned), bits))
    for row, signs in enumerate(turned):
        chosen[row, list(signs)] = 1
    masks = (chosen.astype(np.int64) @ (1 << np.arange(bits))).astype(np.int64)
    weights = 1 << np.arange(bits)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, sides in _sides(frame, tables, bits, seed):
                dim = len(frame.loc[ids.index[0], "vector"])
                cost = (sides**2) @ chosen.T
                best = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]
                yield _rows(ids, "query_id", dim, ((sides > 0) @ weights)[:, :, None] ^ masks[best])

    return _vectors(queries, "query_id").mapInPandas(task, _schema(queries, "query_id"))


def retrieve_by_index(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    index: DataFrame | None = None,
    tables: int = TABLES,
    bits: int = BITS,
    probes: int = PROBES,
    seed: int = SEED,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """About the k nearest docs per query by cosine -> (query_id, doc_id, similarity, place).

    ``index`` is a stored :func:`projection_index` of ``docs`` with the same settings. A
    query meets each vector once, in however many buckets; all that it meets are compared.
    Met pairs grow with both sides and are never rows: vectors travel in blocks of about
    ``block_bytes`` with their buckets, and a block gives out k rows per query.
    """
    if index is None:
        index = projection_index(docs, tables, bits, seed)
    asked = probed_buckets(queries, tables, bits, probes, seed)
    asking = _with_buckets(queries, asked, "query_id", bits)
    stored = _with_buckets(docs, index, "doc_id", bits)
    result_type = T.StructType(
        [asking.schema["query_id"], stored.schema["doc_id"], T.StructField("similarity", T.DoubleType())]
    )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        lengths = right["vector"].map(len)
        for dim, own in left.groupby(left["vector"].map(len)):
            docs = right[lengths == dim]
            if len(docs):
                yield _nearest_met(own, docs, k)

    partial = similarity.compare_blocks(asking, stored, compare, block_bytes, result_type)
    return similarity.nearest(partial, k)


def _with_buckets(df: DataFrame, found: DataFrame, name: str, bits: int) -> DataFrame:
    """(id, vector, buckets): the buckets of all vectors of an id, each as one number."""
    number = (F.col("dim").cast("long") * MOST_TABLES + F.col("table")) * F.lit(1 << bits) + F.col("bucket")
    own = found.groupBy(name).agg(F.collect_set(number).alias("buckets"))
    return _vectors(df, name).join(own, name)


def _nearest_met(queries: pd.DataFrame, docs: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k most similar of the docs that share a bucket with each query."""
    buckets = docs["buckets"]
    places = np.repeat(np.arange(len(docs)), buckets.map(len))
    numbers = np.concatenate(buckets.to_numpy())
    order = np.argsort(numbers, kind="stable")
    numbers, places = numbers[order], places[order]
    ids, unit = docs["doc_id"].to_numpy(), similarity.unit_rows(docs["vector"])
    rows = []
    for query_id, own, vector in zip(
        queries["query_id"], queries["buckets"], similarity.unit_rows(queries["vector"])
    ):
        met = np.zeros(len(docs), bool)
        for a, b in zip(np.searchsorted(numbers, own), np.searchsorted(numbers, own, "right")):
            met[places[a:b]] = True
        met = np.flatnonzero(met)
        sims = np.round(unit[met] @ vector, 12)
        best = similarity.best(sims, ids[met], k)
        rows.append(pd.DataFrame({"query_id": query_id, "doc_id": ids[met[best]], "similarity": sims[best]}))
    return pd.concat(rows)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, neighbours, recall): the share of the exact neighbours that were found."""
    pair = ["query_id", "doc_id"]
    hits = exact.select(*pair).join(found.select(*pair).withColumn("hit", F.lit(1)), pair, "left")
    return hits.agg(
        F.countDistinct("query_id").alias("queries"),
        F.count(F.lit(1)).alias("neighbours"),
        F.avg(F.coalesce("hit", F.lit(0))).alias("recall"),
    )
