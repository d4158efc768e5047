"""Merge targets stored in buckets of their keys, so that a merge shuffles the source only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators.keyed import all_of


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session's catalog, its rows in `buckets` buckets by the hash of its keys and sorted in each.

    Keys are never null: a null one fails the write and the merge. `buckets` should be at least the session's
    spark.sql.shuffle.partitions, or Spark may deal both sides of a join anew to get more tasks.
    """

    name: str
    keys: tuple[str, ...]
    buckets: int

    def _keyed(self, df: DataFrame) -> DataFrame:
        known = all_of([F.col(k).isNotNull() for k in self.keys])
        message = F.lit(f"null in a key of {self.name}: {', '.join(self.keys)}")
        return df.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))

    def write(self, df: DataFrame, path: str | None = None) -> None:
        """Write the whole table; a bucket is one file, sorted by the keys. With a path it lies there, whatever the warehouse."""
        writer = self._keyed(df).repartition(self.buckets, *self.keys).write.format("parquet").mode("overwrite")
        if path is not None:
            writer = writer.option("path", path)
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def merged(self, spark: SparkSession, merge: Callable[..., DataFrame], source: DataFrame, **options) -> DataFrame:
        """merge(target, source, keys) of the keyed merges with this table as the target.

        The source is dealt out as the table is stored, once for all the merge does with it; the target's files are read
        bucket by bucket and neither shuffled nor sorted.
        """
        placed = self._keyed(source).repartition(self.buckets, *self.keys)
        return merge(self.read(spark), placed, list(self.keys), nullable=False, **options)
