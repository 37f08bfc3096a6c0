"""Incremental metric cube with Structured Streaming.

The reference refreshes its cube from a daily schedule with catch-up.  Here a
file-source stream watches the feed and message tables; each micro-batch only
tells which days received new rows, and ``foreachBatch`` rebuilds the cube of
exactly those days from the full tables and publishes them with dynamic
partition overwrite.  Re-publishing a day is idempotent, so a replayed batch
(after a failure, from the checkpoint) gives the same table.
``trigger(availableNow=True)`` is the catch-up run; a processing-time trigger
keeps the cube fresh continuously.  Only the touched days are rebuilt, each on its
own.  A new profile tuple of a user changes earlier days of that user too; those
are republished by a backfill, not by the stream.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedlens.functions.columns import to_day
from feedlens.operators.cube import build_cube, publish_cube
from feedlens.session import shared_path
from feedlens.sources import read_feed, read_messages
from feedlens.sources.schemas import FEED, MESSAGES


def _touched_days(spark: SparkSession, feed_path: str, msgs_path: str) -> DataFrame:
    feed = spark.readStream.schema(FEED).parquet(feed_path)
    msgs = spark.readStream.schema(MESSAGES).parquet(msgs_path)
    return feed.select(to_day("time").alias("event_date")).unionByName(msgs.select(to_day("time").alias("event_date")))


def start_incremental_cube(
    spark: SparkSession,
    feed_path: str,
    msgs_path: str,
    target: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "10 minutes",
    profile: str = "all",
) -> StreamingQuery:
    """Start the stream; returns the StreamingQuery (call ``awaitTermination``)."""
    checkpoint = checkpoint or shared_path(spark, f"feedlens-incremental-cube-{hashlib.md5(target.encode()).hexdigest()}")

    def publish(batch: DataFrame, epoch_id: int) -> None:
        # The days of one batch: a calendar-sized list, not data.
        days = sorted(r.event_date for r in batch.distinct().collect())
        if not days:
            return
        feed, msgs = read_feed(spark, feed_path), read_messages(spark, msgs_path)
        for day in days:
            _, marginals = build_cube(feed, msgs, day, day, profile)
            publish_cube(marginals, target)

    writer = _touched_days(spark, feed_path, msgs_path).writeStream.foreachBatch(publish)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
