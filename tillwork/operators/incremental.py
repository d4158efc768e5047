"""One incremental run from offsets to commit: changed keys, recompute, replace, then record the progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.changes import changed_keys, offset_next_range
from tillwork.sources.sinks import replace_within

TRACKER = "consumer_id string, table_name string, latest_processed_version long"


def progress(tracker: DataFrame) -> DataFrame:
    """The newest recorded version of every consumer and table of an append-only tracker."""
    return tracker.groupBy("consumer_id", "table_name").agg(F.max("latest_processed_version").alias("latest_processed_version"))


def run_incremental(
    feed: DataFrame, table_name: str, tracker_path: str, consumer: str, recompute: Callable[[DataFrame], DataFrame], target: str,
    day_column: str, partition: str,
) -> tuple[int, int] | None:
    """Process the versions of a change feed that the consumer has not seen; returns their range, None if there are none.

    recompute takes a one-column frame of days and returns all rows of those days. They replace exactly
    those days in target, also days left without rows. The tracker row is written last, so a run that fails
    commits nothing and the next one does the same work again.
    """
    spark = feed.sparkSession
    tracker = progress(spark.read.schema(TRACKER).parquet(tracker_path))
    versions = feed.select(F.lit(table_name).alias("table_name"), F.col("_commit_version").cast("long").alias("version"), F.lit(True).alias("feed_enabled")).distinct()
    todo = offset_next_range(tracker, versions, consumer).first()
    if todo is None or todo["end_version"] is None:
        return None
    if todo["history_lost"]:
        raise ValueError(f"{table_name}: the feed no longer holds version {todo['start_version']}")
    start, end = todo["start_version"], todo["end_version"]
    days = changed_keys(feed.filter(F.col("_commit_version").between(start, end)), day_column)
    replace_within(recompute(days), target, [partition], days)
    done = spark.range(1).select(F.lit(consumer).alias("consumer_id"), F.lit(table_name).alias("table_name"), F.lit(end).cast("long").alias("latest_processed_version"))
    done.write.mode("append").parquet(tracker_path)
    return start, end
