"""A corpus from raw documents: language, duplicates, personal data, mix, packing.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evalspark.llm import dedup, language, mixing, packing, pii
from evalspark.llm.common import stored, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with a score of 0.5 or more (operator 6)."""
    return language.known_language(docs)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (operator 1)."""
    return dedup.distinct_documents(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal values (operator 4)."""
    return pii.private(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (operator 2)."""
    return mixing.mix_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences (operator 5)."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_class),
    ("personal_data", replace_personal_data),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]

#: Hashed samples, signatures and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
