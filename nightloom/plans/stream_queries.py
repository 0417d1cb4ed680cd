"""Queries that run the streaming operators once over the events and give what they leave behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import ingest, quiet
from ._common import Queries, scratch

Q = Queries()


def events(spark, sf_dir):
    """The events file as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = ingest.file_stream(spark, f"{sf_dir}/events.parquet*", schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@Q.add("stream_dedup", "select user_id, count(*) as n from (select distinct user_id, event_type, ts from events where event_type <> 'view') group by 1")
def stream_dedup(spark, sf_dir):
    """Repeats of an event within a second are dropped; the rest is counted per user."""
    at = scratch(spark, "dedup")
    kept = ingest.without_repeats(events(spark, sf_dir).filter("event_type <> 'view'"), ["user_id", "event_type", "ts"], "ts")
    return ingest.into_table(kept.select("user_id", "event_type", "ts"), f"{at}/out", f"{at}/checkpoint").groupBy("user_id").agg(F.count("*").alias("n"))


@Q.add("stream_microbatch_counts", "select user_id, max(event_id) as event_id, arg_max(value, event_id) as value from events group by 1")
def stream_microbatch_counts(spark, sf_dir):
    """Micro-batches register the newest event of each user."""
    at = scratch(spark, "batches")
    stream = events(spark, sf_dir).select("user_id", "event_id", "value")
    ingest.run_batches(stream, ingest.register_batch(f"{at}/out", "user_id", "event_id"), f"{at}/checkpoint").awaitTermination()
    return ingest.registered(spark, f"{at}/out", "user_id", "event_id").select("user_id", "event_id", "value")


@Q.add("stream_quiet_files", "select user_id, max(ts) as ts from events group by 1 having max(ts) <= timestamp '2024-01-30 12:00:00' - interval 3 second")
def stream_quiet_files(spark, sf_dir):
    """Paths (here users) whose last change lies at least three seconds back at a given time."""
    at = scratch(spark, "quiet")
    seen = ingest.into_table(events(spark, sf_dir).select("user_id", "event_id", "ts"), f"{at}/out", f"{at}/checkpoint")
    out = ingest.quiet(seen, "user_id", "ts", F.lit("2024-01-30 12:00:00").cast("timestamp"))
    return out.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@Q.add(
    "stream_quiet_state",
    """with e as (select '/data/' || user_id || '.fits' as path, epoch_us(ts) // 1000 as ms, event_type = 'error' as gone from events where event_type <> 'signup'),
    n as (select *, lead(ms) over (partition by path order by ms, gone) as later, max(ms) over () as newest from e)
    select path, make_timestamp(ms * 1000) as changed from n where not gone and coalesce(later - ms > 3000, ms + 3001 <= newest)""",
)
def stream_quiet_state(spark, sf_dir):
    """Each time that a path (here one for each user) has not changed for more than three seconds; errors are deletions."""
    at = scratch(spark, "quiet-state")
    kind = F.create_map(*[F.lit(x) for pair in (("click", "created"), ("view", "modified"), ("purchase", "moved"), ("error", "deleted")) for x in pair])
    stream = events(spark, sf_dir).select(F.concat(F.lit("/data/"), "user_id", F.lit(".fits")).alias("path"), kind[F.col("event_type")].alias("kind"), "ts")
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, quiet.PROVIDER)
    try:
        out = ingest.into_table(quiet.quiet_files(stream, "path", "kind", "ts"), f"{at}/out", f"{at}/checkpoint")
    finally:
        spark.conf.set(store, before)
    return out.select("path", F.col("changed").cast("timestamp_ntz").alias("changed"))


@Q.add("tumbling_windows", "select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n from events group by 1, 2")
def tumbling_windows(spark, sf_dir):
    """Hourly counts per type; the same operator runs on a stream."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = ingest.windowed_counts(rows.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", by=["event_type"])
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@Q.add("sliding_windows", "select to_timestamp(s)::timestamp as start, count(*) as n from (select unnest(generate_series(epoch_us(ts) // 3600000000 * 3600 - 18000, epoch_us(ts) // 3600000000 * 3600, 3600)) as s from events where event_type = 'purchase') group by 1")
def sliding_windows(spark, sf_dir):
    """Windows of six hours that slide by one."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type = 'purchase'")
    out = ingest.windowed_counts(rows.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "6 hours", "1 hour")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))
