"""Session helpers: local sessions for tests and bench, the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", name: str = "evalspark", scratch: str | None = None
) -> SparkSession:
    """Session for one machine; on a cluster the session comes from spark-submit.

    ``scratch`` is its ``spark.checkpoint.dir``.
    """
    count = os.cpu_count() if cores == "*" else int(cores)
    builder = SparkSession.builder
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    return (
        builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(count))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Of a repeated key in model output the last value counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.driver.memory", os.environ.get("EVALSPARK_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting it lies below the warehouse, which a cluster shares too.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, so that writers other than Spark mean the same file system."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = plain.getFileSystem(spark._jsc.hadoopConfiguration())
    return plain.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a new scratch folder and read from there: computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark knows; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder))
