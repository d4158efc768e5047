"""Structured Streaming variant of the incremental flows.

Change rows arrive as files; every micro-batch collapses them and recomputes the days they
touch, replacing those partitions, also those that are left without rows. The checkpoint takes the place of the offset tracker, a
late row just reopens its day, and a replayed batch writes the same partitions again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillwork.operators.changes import changed_keys, collapse_changes
from tillwork.sources.sinks import replace_within


def read_changes(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def recompute_changed_days(
    changes: DataFrame,
    recompute: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    day_column: str = "ord_date",
    partition: str = "date",
) -> StreamingQuery:
    """Per batch: the changed days go to recompute, whose rows replace those days in target.

    recompute takes a one-column frame of days and returns all rows of those days, read from
    the current tables.
    """

    def apply(batch: DataFrame, _: int) -> None:
        days = changed_keys(batch, day_column)
        replace_within(recompute(days), target, [partition], days)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_collapsed(
    changes: DataFrame, keys: list[str], apply: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand every batch's (previous_record, current_record) diff to apply."""

    def collapsed(batch: DataFrame, batch_id: int) -> None:
        apply(collapse_changes(batch, keys), batch_id)

    return changes.writeStream.foreachBatch(collapsed).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
