"""Streams of observation files: what is new, what is quiet, and micro-batches that register it.

A stream of files is read with readStream; duplicates of a path within a short time are dropped under a
watermark; micro-batches hand the newest version of each path to a registry table.  Every query checkpoints to
the folder given, so that a restarted one goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUIET_SECONDS = 3
REPEAT_SECONDS = 1
BATCH_SECONDS = 30


def file_stream(spark: SparkSession, path: str, schema, newest_first: bool = True, per_batch: int | None = None, pattern: str = "[!.]*") -> DataFrame:
    """New parquet files of a directory; names that begin with a dot are files still being written."""
    reader = spark.readStream.schema(schema).option("latestFirst", newest_first).option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)


def without_repeats(stream: DataFrame, key: list[str], at: str, seconds: int = REPEAT_SECONDS) -> DataFrame:
    """Drops events of the same key that come within so many seconds; state is kept for that long only."""
    return stream.withWatermark(at, f"{seconds} seconds").dropDuplicatesWithinWatermark(key)


def quiet(events: DataFrame, path: str, modified: str, now: Column, seconds: int = QUIET_SECONDS) -> DataFrame:
    """The newest event of each path that has not changed for so many seconds."""
    newest = events.groupBy(path).agg(F.max_by(F.struct(*[c for c in events.columns if c != path]), modified).alias("e")).select(path, "e.*")
    return newest.filter(F.col(modified).cast("timestamp") <= now.cast("timestamp") - F.expr(f"interval {seconds} seconds"))


def windowed_counts(stream: DataFrame, at: str, width: str, slide: str | None = None, late: str = "1 day", by: list[str] = ()) -> DataFrame:
    """Events per tumbling or sliding window; events later than the watermark are left out."""
    w = F.window(at, width, slide) if slide else F.window(at, width)
    counts = stream.withWatermark(at, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("start"), *by, "n")


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, continuous: bool = False):
    """Runs each on every micro-batch: every BATCH_SECONDS, or once over what is there."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{BATCH_SECONDS} seconds") if continuous else writer.trigger(availableNow=True)).start()


def into_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there into parquet files and reads them back."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)


def register_batch(target: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch function: appends the newest row per key under the batch's number, so that a repeated batch replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*[c for c in batch.columns if c != key]), order).alias("r")).select(key, "r.*")
        newest.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return each


def registered(spark: SparkSession, target: str, key: str, order: str) -> DataFrame:
    """The newest registered row of each key."""
    rows = spark.read.parquet(target)
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (key, "batch")]), order).alias("r")).select(key, "r.*")
