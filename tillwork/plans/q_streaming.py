"""Queries of the streaming variant, run to completion over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import changes as chg
from tillwork.operators import insights as ins
from tillwork.plans.bindings import Tables
from tillwork.plans.q_changes import SNAPSHOT_VIEWS, scratch, snapshot
from tillwork.plans.q_insights import INSIGHT_VIEWS
from tillwork.plans.registry import query
from tillwork.streaming.change_stream import apply_collapsed, read_changes, recompute_changed_days
from tillwork.streaming.keyed_diffs import maintain_diffs, read_diffs


@query(
    "stream_market_insights",
    """SELECT location_id, strftime(date, '%Y-%m-%d') AS date, transaction_quantity, CAST(transaction_amount AS DOUBLE) AS transaction_amount FROM partner_market
       WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 40 = 0)""",
    INSIGHT_VIEWS,
)
def q_stream_market(t: Tables) -> DataFrame:
    """Every fortieth order changed; its day's market rows are recomputed from all orders."""
    changes, target = scratch(t, "changes"), scratch(t, "market")
    changed = t.retail_orders().filter(F.col("ord_id").cast("bigint") % 40 == 0).select("ord_id", "ord_date")
    changed.repartition(3).write.parquet(changes)

    def recompute(days: DataFrame) -> DataFrame:
        orders = ins.completed_orders_by_location(t.retail_orders(), t.locations(), days)
        return ins.partner_market_insights(orders).select("location_id", "date", "transaction_quantity", "transaction_amount")

    stream = read_changes(t.spark, changes, changed.schema, max_files=2)
    recompute_changed_days(stream, recompute, target, scratch(t, "offsets")).awaitTermination()
    return t.spark.read.parquet(target)


@query(
    "stream_emptied_days",
    """SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, count(*) AS orders FROM orders
       WHERE o_orderkey % 40 <> 0 AND dayofyear(o_orderdate) % 50 <> 0 GROUP BY ALL""",
)
def q_stream_emptied(t: Tables) -> DataFrame:
    """Orders are deleted, on some days all of them; the target was written before."""
    changes, target = scratch(t, "changes"), scratch(t, "days")
    orders = t.retail_orders().select("ord_id", "ord_date")
    gone = (F.col("ord_id").cast("bigint") % 40 == 0) | (F.dayofyear("ord_date") % 50 == 0)

    def by_day(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("ord_date").alias("date")).agg(F.count(F.lit(1)).alias("orders"))

    by_day(orders).write.partitionBy("date").parquet(target)
    changed = orders.filter(gone)
    changed.repartition(3).write.parquet(changes)

    def recompute(days: DataFrame) -> DataFrame:
        return by_day(chg.restrict_to(orders.filter(~gone), days))

    stream = read_changes(t.spark, changes, changed.schema, max_files=2)
    recompute_changed_days(stream, recompute, target, scratch(t, "offsets")).awaitTermination()
    return t.spark.read.parquet(target)


@query(
    "stream_collapse_changes",
    """SELECT k.ord_id, v1.total AS previous_total, v2.total AS current_total
       FROM (SELECT DISTINCT ord_id FROM feed2) k LEFT JOIN v1 USING (ord_id) LEFT JOIN v2 USING (ord_id)""",
    SNAPSHOT_VIEWS,
)
def q_stream_collapse(t: Tables) -> DataFrame:
    changes, target = scratch(t, "changes"), scratch(t, "diff")
    feed = chg.snapshot_changes(snapshot(t, 1), snapshot(t, 2), ["ord_id"], 2)
    feed.write.parquet(changes)

    def save(diff: DataFrame, batch_id: int) -> None:
        rows = diff.select(
            F.coalesce("previous_record.ord_id", "current_record.ord_id").alias("ord_id"),
            F.col("previous_record.total").alias("previous_total"), F.col("current_record.total").alias("current_total"),
        )
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    apply_collapsed(read_changes(t.spark, changes, feed.schema), ["ord_id"], save, scratch(t, "offsets")).awaitTermination()
    return t.spark.read.parquet(target).drop("batch")


@query(
    "stream_keyed_diffs",
    """SELECT k.ord_id, v1.total AS previous_total, v3.total AS current_total
       FROM (SELECT ord_id FROM feed2 UNION SELECT ord_id FROM feed3) k LEFT JOIN v1 USING (ord_id) LEFT JOIN v3 USING (ord_id)
       WHERE v1.ord_id IS NOT NULL OR v3.ord_id IS NOT NULL""",
    SNAPSHOT_VIEWS,
)
def q_stream_keyed(t: Tables) -> DataFrame:
    """Two versions' changes arrive in three batches, a key's rows in different ones; its diff is that of both versions."""
    arriving, target = scratch(t, "changes"), scratch(t, "diffs")
    feed = chg.union_change_sources([chg.snapshot_changes(snapshot(t, v - 1), snapshot(t, v), ["ord_id"], v) for v in (2, 3)])
    feed.repartition(3, F.xxhash64("ord_id", "_change_type", "_commit_version")).write.parquet(arriving)
    stream = read_changes(t.spark, arriving, feed.schema, max_files=1)
    maintain_diffs(stream, ["ord_id"], target, scratch(t, "offsets")).awaitTermination()
    return read_diffs(t.spark, target).select(
        F.coalesce("previous_record.ord_id", "current_record.ord_id").alias("ord_id"),
        F.col("previous_record.total").alias("previous_total"), F.col("current_record.total").alias("current_total"),
    )
