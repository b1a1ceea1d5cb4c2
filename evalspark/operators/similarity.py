"""Vector jobs: pooling, similarity of answer pairs, nearest stored vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from evalspark.functions import fixed, text, vectors


def mean_pool(df: DataFrame, tokens: str = "tokens", mask: str = "mask") -> DataFrame:
    """Token vectors + mask -> one sentence vector of length one per row."""
    pooled = vectors.mean_pool(F.col(tokens), F.col(mask))
    return df.withColumn("vector", vectors.l2_normalise(pooled)).drop(tokens, mask)


def mean_pool_long(df: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """As :func:`mean_pool` over (keys, dim, value, m) rows: (keys, dim, value).

    One row per vector component; texts of any length pool through partial sums.
    """
    weight = F.col("m").cast("double")
    return df.groupBy(*keys, "dim").agg(
        (
            F.sum(F.col("value").cast("double") * weight)
            / F.greatest(F.sum(weight), F.lit(1e-9))
        ).alias("value")
    )


def l2_normalise(df: DataFrame, vector: str = "vector") -> DataFrame:
    return df.withColumn(vector, vectors.l2_normalise(F.col(vector)))


def embedding_similarity(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """(id, vector) with (id, vector) of gold -> (id, cosine_similarity, note).

    A prediction without a gold vector keeps its row, with a null similarity and a note.
    """
    joined = pred.select("id", F.col("vector").alias("_p")).join(
        gold.select("id", F.col("vector").alias("_g"), F.lit(True).alias("_found")), "id", "left"
    )
    note = F.when(F.col("_found").isNull(), F.lit(fixed.NO_GOLD_NOTE))
    return joined.select(
        "id",
        vectors.cosine(F.col("_p"), F.col("_g")).alias("cosine_similarity"),
        note.alias("note"),
    )


def similarity_report(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per prediction and gold answer to its question, none of them lost.

    ``pred`` holds question, predicted_answer and vector, ``gold`` question, gold_answer
    and vector. The result has question, predicted_answer, gold_answer,
    cosine_similarity and note; a prediction without gold has nulls and a note.
    """
    key = text.question_key(F.col("question")).alias("_key")
    found = gold.select(key, "gold_answer", F.col("vector").alias("_g"), F.lit(True).alias("_found"))
    joined = pred.select("*", key).join(found, "_key", "left")
    return joined.select(
        "question",
        "predicted_answer",
        "gold_answer",
        vectors.cosine(F.col("vector"), F.col("_g")).alias("cosine_similarity"),
        F.when(F.col("_found").isNull(), F.lit(fixed.NO_GOLD_NOTE)).alias("note"),
    )


def mean_cosine(similar: DataFrame) -> DataFrame:
    """Mean similarity; pairs without a gold answer have none and do not count."""
    return similar.agg(
        F.avg("cosine_similarity").alias("mean_cosine"),
        F.count("cosine_similarity").alias("pairs"),
    )


# --- nearest vectors -----------------------------------------------------------------


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.maximum(size, 1e-12)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in column])


def unit_rows(column: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of length one; a zero vector stays zero."""
    return _unit_rows(_stack(column))


def best(sims: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest values, lower id first among equals."""
    if len(sims) > k:
        limit = np.partition(sims, len(sims) - k)[len(sims) - k]
        places = np.flatnonzero(sims >= limit)
    else:
        places = np.arange(len(sims))
    return places[np.lexsort((ids[places], -sims[places]))][:k]


def _top_of_block(
    query_ids: np.ndarray, query_unit: np.ndarray, docs: pd.DataFrame, k: int
) -> pd.DataFrame:
    sims = np.round(query_unit @ unit_rows(docs["vector"]).T, 12)
    ids = docs["doc_id"].to_numpy()
    places = [best(row, ids, k) for row in sims]
    counts = [len(p) for p in places]
    return pd.DataFrame(
        {
            "query_id": np.repeat(query_ids, counts),
            "doc_id": ids[np.concatenate(places)],
            "similarity": np.concatenate([s[p] for s, p in zip(sims, places)]),
        }
    )


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return F.coalesce(~odd, F.lit(False))


def unusable_vectors(df: DataFrame, vector: str = "vector") -> DataFrame:
    """Rows that :func:`retrieve_top_k` leaves out."""
    return df.where(~usable(F.col(vector).cast("array<double>")))


def retrieve_top_k(
    queries: DataFrame, docs: DataFrame, k: int, block_bytes: int = 8 << 20
) -> DataFrame:
    """Exact k nearest docs per query by cosine -> (query_id, doc_id, similarity, place).

    Inputs are (query_id, vector) and (doc_id, vector). Vectors that are null or hold a
    null or non-finite component take no part (see :func:`unusable_vectors`). Queries and
    docs are cut into blocks of about ``block_bytes`` of vectors, and each task compares
    one block of either side. It gives out k rows per query, never the compared pairs,
    and a group limit merges them.
    """
    result_type = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    queries, docs = (
        df.select(name, F.col("vector").cast("array<double>").alias("vector")).where(
            usable(F.col("vector"))
        )
        for df, name in ((queries, "query_id"), (docs, "doc_id"))
    )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        unit = unit_rows(left["vector"])
        ids = left["query_id"].to_numpy()
        # As many similarities at a time as a block has components.
        step = max(1, block_bytes // (8 * len(right)))
        for start in range(0, len(left), step):
            part = slice(start, start + step)
            yield _top_of_block(ids[part], unit[part], right, k)

    partial = compare_blocks(queries, docs, compare, block_bytes, result_type)
    return nearest(partial, k)


def nearest(partial: DataFrame, k: int) -> DataFrame:
    """The k most similar rows of each query, lower doc_id first among equals."""
    window = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    return partial.withColumn("place", F.row_number().over(window)).where(
        F.col("place") <= k
    )


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def compare_blocks(
    queries: DataFrame,
    docs: DataFrame,
    compare: Callable[[pd.DataFrame, pd.DataFrame], Iterator[pd.DataFrame]],
    block_bytes: int,
    result_type: T.StructType,
) -> DataFrame:
    """What ``compare`` finds in each pair of a block of queries and a block of docs."""

    def blocks_of(df: DataFrame) -> int:
        arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        components = df.agg(F.sum(reduce(Column.__add__, map(F.size, arrays)))).first()[0] or 0
        return max(1, -(-8 * components // block_bytes))

    blocks, shards = blocks_of(queries), blocks_of(docs)
    spread_queries = queries.select(
        "*",
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"),
        F.explode(_numbers(shards)).alias("shard"),
    )
    spread_docs = docs.select(
        "*",
        F.explode(_numbers(blocks)).alias("block"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"),
    )

    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame(columns=result_type.names)
        if left.empty or right.empty:
            return none
        return pd.concat(list(compare(left, right)) or [none])

    return (
        spread_queries.groupBy("block", "shard")
        .cogroup(spread_docs.groupBy("block", "shard"))
        .applyInPandas(task, result_type)
    )
