"""Run log: parameters, metrics, artifact paths and tags as tables of commits.

A commit is one call's rows of one run in one table, a folder of its own. Spark stages a
commit's files and moves them when all are written, replacing the folder; so a call that
is repeated, by hand or by a retry, leaves its rows once, and other commits stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMAS = {
    "run_params": "experiment STRING, run_id STRING, key STRING, value STRING",
    "run_metrics": (
        "experiment STRING, run_id STRING, key STRING, step LONG, value DOUBLE"
    ),
    "run_artifacts": "experiment STRING, run_id STRING, path STRING",
    "run_tags": "experiment STRING, run_id STRING, key STRING, value STRING",
}


def append_run_table(df: DataFrame, root: str, table: str, commit: str = "0") -> None:
    """Write one commit of any number of runs to one of the four tables.

    It replaces the commit of the same name of these runs, and nothing else.
    """
    columns = [part.split()[0] for part in SCHEMAS[table].split(", ")]
    (
        df.select(*columns, F.lit(commit).alias("commit"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("experiment", "run_id", "commit")
        .parquet(f"{root}/{table}")
    )


def _rows(spark: SparkSession, table: str, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMAS[table])


def log_run(
    spark: SparkSession,
    root: str,
    experiment: str,
    run_id: str,
    params: Mapping[str, object] | None = None,
    metrics: DataFrame | Mapping[str, float] | None = None,
    artifacts: Sequence[str] = (),
    step: int = 0,
    commit: str | None = None,
) -> None:
    """Log one run. ``metrics`` is a mapping or a (key, value[, step]) table.

    A metrics table is written by the executors; a mapping is a few literal rows. Calls
    with other steps add to a run; the same step again replaces what it logged before.
    ``commit`` names the call instead of the step.
    """
    commit = commit or str(step)
    if params:
        rows = [(experiment, run_id, k, str(v)) for k, v in params.items()]
        append_run_table(_rows(spark, "run_params", rows), root, "run_params", commit)
    if isinstance(metrics, DataFrame):
        at = F.col("step") if "step" in metrics.columns else F.lit(step)
        table = metrics.select(
            F.lit(experiment).alias("experiment"),
            F.lit(run_id).alias("run_id"),
            "key",
            at.cast("long").alias("step"),
            F.col("value").cast("double").alias("value"),
        )
        append_run_table(table, root, "run_metrics", commit)
    elif metrics:
        rows = [(experiment, run_id, k, step, float(v)) for k, v in metrics.items()]
        append_run_table(_rows(spark, "run_metrics", rows), root, "run_metrics", commit)
    if artifacts:
        rows = [(experiment, run_id, path) for path in artifacts]
        append_run_table(_rows(spark, "run_artifacts", rows), root, "run_artifacts", commit)


def tag_run(
    spark: SparkSession,
    root: str,
    experiment: str,
    run_id: str,
    tags: Mapping[str, str],
) -> None:
    """Tags of a run, a commit for each key: a key's new value replaces the old one."""
    for key, value in tags.items():
        append_run_table(_rows(spark, "run_tags", [(experiment, run_id, key, value)]), root, "run_tags", key)


def read_run_table(
    spark: SparkSession, root: str, table: str, experiment: str | None = None
) -> DataFrame:
    """One of the four tables; naming the experiment prunes its partitions."""
    schema = f"{SCHEMAS[table]}, commit STRING"
    df = spark.read.schema(schema).parquet(f"{root}/{table}").drop("commit")
    return df if experiment is None else df.where(F.col("experiment") == experiment)


def runs_with_tag(df: DataFrame, tags: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of the runs that carry a tag."""
    tagged = tags.where((F.col("key") == key) & (F.col("value") == value))
    return df.join(tagged.select("experiment", "run_id"), ["experiment", "run_id"], "left_semi")
