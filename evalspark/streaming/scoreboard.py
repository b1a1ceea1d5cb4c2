"""Scoreboard over a stream of result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from evalspark.sources import sums


def stream_scoreboard(
    results: DataFrame,
    event_time: str = "ts",
    window: str = "1 hour",
    watermark: str = "1 day",
) -> DataFrame:
    """Success rate and score per window and task; works on a stream and on a table.

    State is one row per open window and task, and the watermark closes windows. A
    time without zone is taken as session time, since watermarks need an instant.
    """
    timed = results.withColumn(event_time, F.col(event_time).cast("timestamp"))
    if results.isStreaming:
        timed = timed.withWatermark(event_time, watermark)
    return (
        timed.groupBy(F.window(event_time, window).alias("w"), "task")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.avg(F.coalesce("success", F.lit(False)).cast("int")).alias("success_rate"),
            F.avg("score").alias("score"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "task",
            "items",
            "success_rate",
            "score",
        )
    )


def start_scoreboard(
    results: DataFrame, table: str, checkpoint: str, **options
) -> StreamingQuery:
    """Run until stopped: closed windows are appended to a Parquet folder, once each."""
    return (
        stream_scoreboard(results, **options)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", table)
        .start()
    )


def window_sums(results: DataFrame, event_time: str = "ts", window: str = "1 hour") -> DataFrame:
    """Sums per window and task that add up over any cut of the results."""
    start = F.window(F.col(event_time).cast("timestamp"), window)["start"]
    return results.groupBy(start.alias("window_start"), "task").agg(
        F.count(F.lit(1)).alias("items"),
        F.count(F.when(F.col("success"), 1)).alias("successes"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("scored"),
    )


def drain_scoreboard(
    results: DataFrame, table: str, checkpoint: str, compact_every: int = 64, **options
) -> DataFrame:
    """Process all that has arrived, open windows included, and return the whole board.

    Each micro-batch is summed by itself and its sums are added to the table of sums, so
    the stream keeps no state at all, and a row counts however late it comes. A batch that
    is run again after a failure replaces its own sums. After ``compact_every`` batches the
    sums so far become one base.
    """
    spark = results.sparkSession
    keys = ["window_start", "task"]

    def fold(batch: DataFrame, batch_id: int) -> None:
        sums.add_batch(window_sums(batch, **options), table, batch_id)
        if batch_id % compact_every == compact_every - 1:
            sums.compact(batch.sparkSession, table, keys)

    query = (
        results.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(fold)
        .start()
    )
    query.awaitTermination()
    found = sums.read_sums(spark, table, keys)
    if found is None:
        return spark.createDataFrame([], stream_scoreboard(results, **options).schema)
    return found.select(
        *keys,
        "items",
        F.try_divide("successes", "items").alias("success_rate"),
        F.try_divide("score_sum", "scored").alias("score"),
    )
