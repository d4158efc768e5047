"""The intermediate identity table: one partition per feed date and run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.sources.sinks import replace_partitions


def identity_partition_write(identities: DataFrame, path: str, feed_date: str, run_id: str) -> None:
    """Replace the partition of this feed date and run."""
    stamped = identities.withColumns({"feed_date": F.lit(feed_date).cast("date"), "run_id": F.lit(run_id)})
    replace_partitions(stamped, path, ["feed_date", "run_id"])
