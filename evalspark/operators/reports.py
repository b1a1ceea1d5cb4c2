"""Alignment reports -> request id, status, region, organism, gene."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evalspark.functions import reports


def parse_reports(
    df: DataFrame, column: str = "report", mode: str = "as_documented"
) -> DataFrame:
    """Every field of a report in one projection; the text itself is not kept."""
    text, hit = F.col(column), F.col("_hit")
    kept = [c for c in df.columns if c != column]
    # The hit line is a column of its own: the organism rules read it many times.
    return df.withColumn("_hit", reports.first_hit(text)).select(
        *kept,
        reports.request_id(text).alias("request_id"),
        reports.status(text).alias("status"),
        reports.region(text, mode).alias("region"),
        hit.alias("first_hit"),
        reports.organism(hit).alias("organism"),
        reports.organism_by_pattern(hit).alias("organism_name"),
        reports.gene(text).alias("gene"),
    )
