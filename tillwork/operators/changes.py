"""Change feeds: difference of two snapshots, collapse to one diff per key, offsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.keyed import all_of, merge_upsert

FEED_COLUMNS = ["_change_type", "_commit_version"]


def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Change rows that lead from one snapshot to the next."""
    fields = old.columns
    before = old.select(F.struct(*fields).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    after = new.select(F.struct(*fields).alias("_new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    on = all_of([before[f"_o_{k}"].eqNullSafe(after[f"_n_{k}"]) for k in keys])
    paired = before.join(after, on, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    was, now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    steps = F.array(
        F.when(was, F.struct(F.when(now, "update_preimage").otherwise("delete").alias("t"), F.col("_old").alias("r"))),
        F.when(now, F.struct(F.when(was, "update_postimage").otherwise("insert").alias("t"), F.col("_new").alias("r"))),
    )
    step = paired.select(F.explode(F.array_compact(steps)).alias("s"))
    return step.select("s.r.*", F.col("s.t").alias("_change_type"), F.lit(version).cast("bigint").alias("_commit_version"))


def collapse_changes(feed: DataFrame, keys: list[str]) -> DataFrame:
    """One (previous_record, current_record) per key over all versions in the feed.

    Previous: the first of insert / preimage / delete, null when that is an insert.
    Current: the last of insert / postimage / delete, null when that is a delete.
    Equal versions: a delete precedes an insert.
    """
    missing = [c for c in FEED_COLUMNS if c not in feed.columns]
    if missing:
        raise ValueError(f"not a change feed, no column {missing}")
    fields = [c for c in feed.columns if c not in (*FEED_COLUMNS, "_commit_timestamp")]
    kind = F.col("_change_type")
    ranked = feed.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.struct(kind.alias("kind"), F.struct(*fields).alias("record")).alias("_row"),
        F.struct("_commit_version", F.when(kind == "insert", 1).when(kind == "update_postimage", 1).otherwise(0)).alias("_at"),
    )
    rows = ranked.groupBy(*[f"_k_{k}" for k in keys]).agg(
        F.expr("min_by(_row, _at) FILTER (WHERE _row.kind IN ('insert', 'update_preimage', 'delete'))").alias("first"),
        F.expr("max_by(_row, _at) FILTER (WHERE _row.kind IN ('insert', 'update_postimage', 'delete'))").alias("last"),
    )
    return rows.select(
        F.when(F.col("first.kind") != "insert", F.col("first.record")).alias("previous_record"),
        F.when(F.col("last.kind") != "delete", F.col("last.record")).alias("current_record"),
    ).filter(F.col("previous_record").isNotNull() | F.col("current_record").isNotNull())


def snapshot_as_diff(df: DataFrame) -> DataFrame:
    """A whole table as current records with null previous ones."""
    record = F.struct(*df.columns)
    return df.select(F.when(F.lit(False), record).alias("previous_record"), record.alias("current_record"))


def union_change_sources(feeds: list[DataFrame]) -> DataFrame:
    """Union of feeds that must have the same columns and types."""
    shapes = [sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields) for df in feeds]
    for shape in shapes[1:]:
        if shape != shapes[0]:
            raise ValueError(f"change sources differ: {sorted(set(shape) ^ set(shapes[0]))}")
    return reduce(DataFrame.unionByName, feeds)


def changed_keys(feed: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values to recompute; stays a frame for a left_semi join."""
    return feed.select(column).filter(F.col(column).isNotNull()).distinct()


def restrict_to(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys, keys.columns, "left_semi")


def offset_next_range(tracker: DataFrame, versions: DataFrame, consumer: str) -> DataFrame:
    """Per table the versions a consumer must read next.

    versions has table_name, version, feed_enabled. A consumer starts one after its last
    processed version, else at the first feed-enabled one; an empty range has null ends.
    history_lost marks a start older than what is still kept.
    """
    available = versions.groupBy("table_name").agg(
        F.max("version").alias("latest"),
        F.min("version").alias("earliest"),
        F.min(F.when(F.col("feed_enabled"), F.col("version"))).alias("first_enabled"),
    )
    done = tracker.filter(F.col("consumer_id") == consumer).select("table_name", "latest_processed_version")
    start = F.coalesce(F.col("latest_processed_version") + 1, F.col("first_enabled"))
    todo = start <= F.col("latest")
    return available.join(done, "table_name", "left").select(
        "table_name",
        F.when(todo, start).alias("start_version"),
        F.when(todo, F.col("latest")).alias("end_version"),
        F.coalesce(todo & (start < F.col("earliest")), F.lit(False)).alias("history_lost"),
    )


def offset_commit(tracker: DataFrame, processed: DataFrame, consumer: str) -> DataFrame:
    """Record processed versions (table_name, end_version) after the write succeeded."""
    rows = processed.filter(F.col("end_version").isNotNull()).select(
        F.lit(consumer).alias("consumer_id"), "table_name", F.col("end_version").alias("latest_processed_version")
    )
    return merge_upsert(tracker, rows, ["consumer_id", "table_name"])


def full_scan_source(table: DataFrame, version: str) -> DataFrame:
    """All rows of the newest version of a table with a version column, which is the offset to commit."""
    newest = table.agg(F.max(version).alias(version))
    return table.join(newest, version).select(*table.columns)
