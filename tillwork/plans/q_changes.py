"""Queries of the change feed, the offsets and the keyed merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import changes as chg
from tillwork.operators import incremental as inc
from tillwork.operators import keyed
from tillwork.plans.bindings import Tables
from tillwork.plans.registry import query
from tillwork.session import scratch_folder
from tillwork.sources.bucketed import BucketedTable


def order_key():
    return F.col("o_orderkey")


def price_col():
    return F.col("o_totalprice")



def scratch(t: Tables, name: str) -> str:
    """A new folder in the shared checkpoint area."""
    return scratch_folder(t.spark, name)


def snapshot(t: Tables, version: int) -> DataFrame:
    """Version 1 lacks every tenth key, 2 every eleventh, 3 every thirteenth; 2 and 3 amend."""
    orders = t.read("orders")
    one = F.lit(1.0) * (order_key() % 7 == 0).cast("int")
    two = one + F.lit(2.0) * (order_key() % 5 == 0).cast("int")
    price, gap = {1: (price_col(), 10), 2: (price_col() + one, 11), 3: (price_col() + two, 13)}[version]
    return orders.filter(order_key() % gap != 0).select(
        order_key().alias("ord_id"), "o_custkey", price.alias("total"), F.col("o_orderdate").cast("date").alias("ord_date")
    )


def feed(t: Tables) -> DataFrame:
    steps = [chg.snapshot_changes(snapshot(t, v - 1), snapshot(t, v), ["ord_id"], v) for v in (2, 3)]
    return chg.union_change_sources(steps)


SNAPSHOT_VIEWS = {
    f"v{v}": f"""SELECT o_orderkey AS ord_id, o_custkey, {price} AS total, CAST(o_orderdate AS DATE) AS ord_date
                 FROM orders WHERE o_orderkey % {gap} <> 0"""
    for v, price, gap in (
        (1, "o_totalprice", 10),
        (2, "o_totalprice + 1.0::DOUBLE * CAST(o_orderkey % 7 = 0 AS INTEGER)", 11),
        (3, "o_totalprice + (1.0::DOUBLE * CAST(o_orderkey % 7 = 0 AS INTEGER) + 2.0::DOUBLE * CAST(o_orderkey % 5 = 0 AS INTEGER))", 13),
    )
}
for new in (2, 3):
    old = new - 1
    SNAPSHOT_VIEWS[f"feed{new}"] = f"""
        SELECT n.*, 'insert' AS _change_type, {new} AS _commit_version FROM v{new} n WHERE n.ord_id NOT IN (SELECT ord_id FROM v{old})
        UNION ALL SELECT o.*, 'delete', {new} FROM v{old} o WHERE o.ord_id NOT IN (SELECT ord_id FROM v{new})
        UNION ALL SELECT o.*, 'update_preimage', {new} FROM v{old} o JOIN v{new} n USING (ord_id) WHERE o.total <> n.total
        UNION ALL SELECT n.*, 'update_postimage', {new} FROM v{old} o JOIN v{new} n USING (ord_id) WHERE o.total <> n.total"""
SNAPSHOT_VIEWS["all_changes"] = "SELECT * FROM feed2 UNION ALL SELECT * FROM feed3"


@query(
    "snapshot_changes",
    "SELECT * EXCLUDE (ord_date, _commit_version), strftime(ord_date, '%Y-%m-%d') AS ord_date, CAST(_commit_version AS BIGINT) AS _commit_version FROM feed2",
    SNAPSHOT_VIEWS,
)
def q_snapshot_changes(t: Tables) -> DataFrame:
    return chg.snapshot_changes(snapshot(t, 1), snapshot(t, 2), ["ord_id"], 2)


@query(
    "collapse_changes",
    """SELECT k.ord_id, v1.total AS previous_total, v3.total AS current_total
       FROM (SELECT DISTINCT ord_id FROM all_changes) k LEFT JOIN v1 USING (ord_id) LEFT JOIN v3 USING (ord_id)
       WHERE v1.ord_id IS NOT NULL OR v3.ord_id IS NOT NULL""",
    SNAPSHOT_VIEWS,
)
def q_collapse(t: Tables) -> DataFrame:
    diff = chg.collapse_changes(feed(t), ["ord_id"])
    return diff.select(
        F.coalesce("previous_record.ord_id", "current_record.ord_id").alias("ord_id"),
        F.col("previous_record.total").alias("previous_total"),
        F.col("current_record.total").alias("current_total"),
    )


@query(
    "snapshot_as_diff",
    "SELECT true AS no_previous, ord_id, total FROM v1",
    SNAPSHOT_VIEWS,
)
def q_as_diff(t: Tables) -> DataFrame:
    return chg.snapshot_as_diff(snapshot(t, 1)).select(
        F.col("previous_record").isNull().alias("no_previous"), "current_record.ord_id", "current_record.total"
    )


@query(
    "union_change_sources",
    "SELECT * EXCLUDE (ord_date, _commit_version), strftime(ord_date, '%Y-%m-%d') AS ord_date, CAST(_commit_version AS BIGINT) AS _commit_version FROM all_changes",
    SNAPSHOT_VIEWS,
)
def q_union(t: Tables) -> DataFrame:
    return feed(t)


@query("full_scan_source", "SELECT ord_id, total, CAST(2 AS BIGINT) AS offset_version FROM v2", SNAPSHOT_VIEWS)
def q_full_scan(t: Tables) -> DataFrame:
    """A table that holds the rows of two versions."""
    history = snapshot(t, 1).withColumn("version", F.lit(1)).unionByName(snapshot(t, 2).withColumn("version", F.lit(2)))
    return chg.full_scan_source(history, "version").select("ord_id", "total", F.col("version").cast("bigint").alias("offset_version"))


@query("changed_keys", "SELECT DISTINCT strftime(ord_date, '%Y-%m-%d') AS ord_date FROM feed2", SNAPSHOT_VIEWS)
def q_changed_keys(t: Tables) -> DataFrame:
    return chg.changed_keys(chg.snapshot_changes(snapshot(t, 1), snapshot(t, 2), ["ord_id"], 2), "ord_date")


# ---- offsets ------------------------------------------------------------------------


def table_versions(t: Tables) -> DataFrame:
    """One table per partner, one version per year; feeds are kept since 1997, enabled at 1998."""
    year = F.year("ord_date")
    return t.retail_orders().filter(year >= 1997).select(
        F.col("partner_id").alias("table_name"), (year - 1990).cast("bigint").alias("version"), (year >= 1998).alias("feed_enabled")
    ).distinct()


def tracker(t: Tables) -> DataFrame:
    """p0 has read all, p1..p3 lag, p4 was never read; p3 lags behind the kept history."""
    n = F.substring("partner_id", 2, 1).cast("int")
    latest = t.retail_orders().groupBy("partner_id").agg(F.max(F.year("ord_date") - 1990).alias("latest"))
    return latest.filter(n < 4).select(
        F.lit("insights").alias("consumer_id"),
        F.col("partner_id").alias("table_name"),
        (F.col("latest") - n * 2).cast("bigint").alias("latest_processed_version"),
    )


OFFSET_VIEWS = {
    "table_versions": """SELECT DISTINCT partner_id AS table_name, CAST(year(ord_date) - 1990 AS BIGINT) AS version, year(ord_date) >= 1998 AS feed_enabled
                         FROM retail_orders WHERE year(ord_date) >= 1997""",
    "tracker": """SELECT partner_id AS table_name, CAST(max(year(ord_date)) - 1990 - CAST(partner_id[2] AS INTEGER) * 2 AS BIGINT) AS done
                  FROM retail_orders WHERE CAST(partner_id[2] AS INTEGER) < 4 GROUP BY partner_id""",
    "next_range": """
        SELECT table_name, CASE WHEN start_at <= latest THEN start_at END AS start_version,
               CASE WHEN start_at <= latest THEN latest END AS end_version,
               start_at <= latest AND start_at < earliest AS history_lost
        FROM (SELECT v.table_name, max(version) AS latest, min(version) AS earliest,
                     coalesce(min(done) + 1, min(version) FILTER (feed_enabled)) AS start_at
              FROM table_versions v LEFT JOIN tracker USING (table_name) GROUP BY v.table_name)""",
}


@query("offset_next_range", "SELECT * FROM next_range", OFFSET_VIEWS)
def q_offset_range(t: Tables) -> DataFrame:
    return chg.offset_next_range(tracker(t), table_versions(t), "insights")


@query(
    "offset_commit",
    """SELECT 'insights' AS consumer_id, table_name, coalesce(end_version, done) AS latest_processed_version
       FROM next_range LEFT JOIN tracker USING (table_name)""",
    OFFSET_VIEWS,
)
def q_offset_commit(t: Tables) -> DataFrame:
    todo = chg.offset_next_range(tracker(t), table_versions(t), "insights")
    return chg.offset_commit(tracker(t), todo, "insights")


@query(
    "incremental_run",
    """SELECT strftime(ord_date, '%Y-%m-%d') AS day, count(*) AS orders, round(sum(total), 2) AS total, CAST(3 AS BIGINT) AS committed
       FROM v3 WHERE day(ord_date) <> 13 GROUP BY ord_date""",
    SNAPSHOT_VIEWS,
)
def q_incremental_run(t: Tables) -> DataFrame:
    """Totals by day were made from version 1; versions 2 and 3 follow, and 3 empties the 13th of every month."""
    last = snapshot(t, 3).filter(F.dayofmonth("ord_date") != 13)
    changes = chg.union_change_sources([
        chg.snapshot_changes(snapshot(t, 1), snapshot(t, 2), ["ord_id"], 2), chg.snapshot_changes(snapshot(t, 2), last, ["ord_id"], 3)
    ])

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("ord_date").alias("day")).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("total"), 2).alias("total"))

    target, tracker = scratch(t, "totals"), scratch(t, "tracker")
    totals(snapshot(t, 1)).write.partitionBy("day").parquet(target)
    t.spark.createDataFrame([("totals", "orders", 1)], inc.TRACKER).write.parquet(tracker)
    inc.run_incremental(changes, "orders", tracker, "totals", lambda days: totals(chg.restrict_to(last, days)), target, "ord_date", "day")
    committed = inc.progress(t.spark.read.parquet(tracker)).first()["latest_processed_version"]
    return t.spark.read.parquet(target).withColumn("committed", F.lit(committed))


# ---- merges -------------------------------------------------------------------------


def target(t: Tables) -> DataFrame:
    return t.read("orders").filter(order_key() % 3 != 0).select(
        order_key().alias("ord_id"), price_col().alias("total"), F.col("o_custkey").alias("customer"), F.lit("old").alias("tag"),
        F.year("o_orderdate").alias("yr"),
    )


def source(t: Tables) -> DataFrame:
    return t.read("orders").filter(order_key() % 2 == 0).select(
        order_key().alias("ord_id"), (price_col() + 10).alias("total"), (F.col("o_custkey") + 1).alias("customer"), F.lit("new").alias("tag"),
        F.year("o_orderdate").alias("yr"),
    )


MERGE_VIEWS = {
    "tgt": "SELECT o_orderkey AS ord_id, o_totalprice AS total, o_custkey AS customer, 'old' AS tag, year(o_orderdate) AS yr FROM orders WHERE o_orderkey % 3 <> 0",
    "src": "SELECT o_orderkey AS ord_id, o_totalprice + 10 AS total, o_custkey + 1 AS customer, 'new' AS tag, year(o_orderdate) AS yr FROM orders WHERE o_orderkey % 2 = 0",
}
KEY = ["ord_id"]


@query("merge_upsert", "SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE ord_id NOT IN (SELECT ord_id FROM src)", MERGE_VIEWS)
def q_upsert(t: Tables) -> DataFrame:
    return keyed.merge_upsert(target(t), source(t), KEY)


@query("merge_insert_only", "SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE ord_id NOT IN (SELECT ord_id FROM tgt)", MERGE_VIEWS)
def q_insert_only(t: Tables) -> DataFrame:
    return keyed.merge_insert_only(target(t), source(t), KEY)


@query(
    "merge_conditional",
    """SELECT t.ord_id, t.total + s.total AS total, greatest(t.customer, s.customer) AS customer, t.tag, t.yr
       FROM tgt t JOIN src s USING (ord_id) WHERE t.total + s.total > 500000
       UNION ALL SELECT * FROM tgt WHERE ord_id NOT IN (SELECT ord_id FROM src)
       UNION ALL SELECT * FROM src WHERE ord_id NOT IN (SELECT ord_id FROM tgt)""",
    MERGE_VIEWS,
)
def q_conditional(t: Tables) -> DataFrame:
    both = F.col("total") + F.col("s_total")
    return keyed.merge_conditional(
        target(t), source(t), KEY,
        update={"total": both, "customer": F.greatest("customer", "s_customer")},
        keep=both > 500000,
    )


@query("merge_delete", "SELECT * FROM tgt WHERE ord_id NOT IN (SELECT ord_id FROM src)", MERGE_VIEWS)
def q_delete(t: Tables) -> DataFrame:
    return keyed.merge_delete(target(t), source(t), KEY)


@query(
    "merge_partial_update",
    """SELECT t.ord_id, t.total, s.customer, t.tag, t.yr FROM tgt t JOIN src s USING (ord_id)
       UNION ALL SELECT * FROM tgt WHERE ord_id NOT IN (SELECT ord_id FROM src)
       UNION ALL SELECT * FROM src WHERE ord_id NOT IN (SELECT ord_id FROM tgt)""",
    MERGE_VIEWS,
)
def q_partial(t: Tables) -> DataFrame:
    return keyed.merge_partial_update(target(t), source(t), KEY, ["customer"])


def bucketed(t: Tables) -> BucketedTable:
    """The target stored in buckets, in a folder and under a name of its own."""
    path = scratch(t, "bucketed")
    table = BucketedTable(f"merge_target_{path[-12:]}", ("ord_id",), max(16, int(t.spark.conf.get("spark.sql.shuffle.partitions"))))
    table.write(target(t), path)
    return table


@query("merge_upsert_bucketed", "SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE ord_id NOT IN (SELECT ord_id FROM src)", MERGE_VIEWS)
def q_upsert_bucketed(t: Tables) -> DataFrame:
    return bucketed(t).merged(t.spark, keyed.merge_upsert, source(t))


@query(
    "merge_partial_update_bucketed",
    """SELECT t.ord_id, t.total, s.customer, t.tag, t.yr FROM tgt t JOIN src s USING (ord_id)
       UNION ALL SELECT * FROM tgt WHERE ord_id NOT IN (SELECT ord_id FROM src)
       UNION ALL SELECT * FROM src WHERE ord_id NOT IN (SELECT ord_id FROM tgt)""",
    MERGE_VIEWS,
)
def q_partial_bucketed(t: Tables) -> DataFrame:
    return bucketed(t).merged(t.spark, keyed.merge_partial_update, source(t), columns=["customer"])


@query(
    "overwrite_where",
    """SELECT * FROM tgt WHERE yr NOT IN (1996, 1999, 2001) UNION ALL SELECT * FROM src WHERE yr IN (1996, 1999, 2001)""",
    MERGE_VIEWS,
)
def q_overwrite(t: Tables) -> DataFrame:
    years = source(t).select("yr").filter(F.col("yr").isin(1996, 1999, 2001)).distinct()
    return keyed.overwrite_where(target(t), source(t), "yr", years)


@query("full_reload", "SELECT * FROM src", MERGE_VIEWS)
def q_reload(t: Tables) -> DataFrame:
    return keyed.full_reload(target(t), source(t))
