"""Queries of the landing and raw shaping operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.plans.bindings import FEED_DATE, Tables
from tillwork.plans.pos_raw import obj, text
from tillwork.plans.q_changes import scratch
from tillwork.plans.q_fields import cust_key, cycle, cycle_sql
from tillwork.plans.registry import query
from tillwork.sources import landing as land
from tillwork.sources.sinks import write_partitioned


def landed_customers(t: Tables) -> str:
    """Customers as JSON files in one folder per segment."""
    path = scratch(t, "landing")
    t.read("customer").withColumn("segment", F.lower("c_mktsegment")).write.partitionBy("segment").json(path)
    return path


CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_mktsegment STRING"


@query("ingest_landing", "SELECT c_custkey, c_name, 'segment=' || lower(c_mktsegment) AS folder FROM customer")
def q_ingest(t: Tables) -> DataFrame:
    df = land.ingest_landing(t.spark, landed_customers(t), "json", CUSTOMER_SCHEMA)
    return df.select("c_custkey", "c_name", F.substring_index(land.path_tail(F.col("_path"), 2), "/", 1).alias("folder"))


@query(
    "stamp_provenance",
    f"SELECT c_custkey, '{FEED_DATE}' AS feed_date, 'segment=' || lower(c_mktsegment) AS file_folder, 's1' AS source_id, true AS has_row_id FROM customer",
)
def q_stamp(t: Tables) -> DataFrame:
    df = land.ingest_landing(t.spark, landed_customers(t), "json", CUSTOMER_SCHEMA)
    stamped = land.stamp_provenance(df, FEED_DATE, "s1", 2)
    return stamped.select(
        "c_custkey", "feed_date", F.substring_index("file_name", "/", 1).alias("file_folder"), "source_id",
        (F.length("row_id") == 36).alias("has_row_id"),
    )


@query("write_partitioned", "SELECT c_custkey, lower(c_mktsegment) AS segment, CAST(i AS BIGINT) AS batch FROM customer, (SELECT unnest([1, 2]) AS i)")
def q_write(t: Tables) -> DataFrame:
    """A guarded first write, then an append to the same partitions."""
    path = scratch(t, "raw")
    rows = t.read("customer").select("c_custkey", F.lower("c_mktsegment").alias("segment"))
    write_partitioned(rows.withColumn("batch", F.lit(1)), path, ["segment"], first=True)
    write_partitioned(rows.withColumn("batch", F.lit(2)), path, ["segment"])
    return t.spark.read.parquet(path)


# ---- documents with many entities ---------------------------------------------------


PAGE_KEYS = 2500  # keys per document, about 100 records of a nation: a document's size does not grow with the table


def page(key: str):
    return F.floor(F.col(key) / PAGE_KEYS)


def wide_documents(t: Tables) -> DataFrame:
    """Pages of a nation's customers and suppliers, either list may be missing; the first has the header."""
    customers = t.read("customer").groupBy(F.col("c_nationkey").alias("n"), page("c_custkey").alias("page")).agg(
        F.collect_list(obj(id=F.col("c_custkey"), name=F.col("c_name"))).alias("customers")
    )
    suppliers = t.read("supplier").groupBy(F.col("s_nationkey").alias("n"), page("s_suppkey").alias("page")).agg(F.collect_list("s_name").alias("suppliers"))
    headers = t.read("nation").select(F.col("n_nationkey").alias("n"), F.lit(0).cast("long").alias("page"), obj(title=F.col("n_name")).alias("header"))
    return headers.join(customers, ["n", "page"], "full").join(suppliers, ["n", "page"], "full").select(
        "n", "customers", "suppliers", "header",
        F.lit(FEED_DATE).alias("feed_date"), text("file", F.col("n")).alias("file_name"), F.lit("s1").alias("source_id"),
    )


WIDE_SQL = f"""
    SELECT record_type, record_value, '{FEED_DATE}' AS feed_date, 'file' || n AS file_name, 's1' AS source_id {{extra}} FROM (
        SELECT 'customers' AS record_type, '{{{{"id":' || c_custkey || ',"name":"' || c_name || '"}}}}' AS record_value, c_nationkey AS n FROM customer
        UNION ALL SELECT 'suppliers', s_name, s_nationkey FROM supplier
        UNION ALL SELECT 'header', '{{{{"title":"' || n_name || '"}}}}', n_nationkey FROM nation)"""


def _wide(extra: str = "") -> str:
    return WIDE_SQL.replace("{extra}", extra).replace("{{", "{").replace("}}", "}")


@query("explode_records_wide", _wide())
def q_wide(t: Tables) -> DataFrame:
    return land.explode_records_wide(wide_documents(t).withColumnRenamed("n", "cursor"))


@query("explode_records_simphony", _wide(", 'loc' || n AS loc_ref, '2024-01-01' AS bus_dt"))
def q_simphony(t: Tables) -> DataFrame:
    docs = wide_documents(t).select("customers", "suppliers", "header", *land.COMMON, text("loc", F.col("n")).alias("locRef"), F.lit(FEED_DATE).alias("busDt"))
    return land.explode_records_simphony(docs)


@query("explode_records_qubeyond", _wide(", CAST(n AS BIGINT) AS req_location_id, 'all' AS req_data_type, 'd' || n AS data_delta"))
def q_qubeyond(t: Tables) -> DataFrame:
    n = F.col("n")
    docs = wide_documents(t).select(
        obj(customers=F.col("customers"), suppliers=F.col("suppliers"), header=F.col("header")).alias("data"), *land.COMMON,
        (n + 1).cast("bigint").alias("req_customer_id"), n.cast("bigint").alias("req_location_id"), F.lit("all").alias("req_data_type"),
        F.lit("none").alias("req_sub_data_type"), text("d", n).alias("data_delta"), F.lit("a").alias("req_start_date"), F.lit("b").alias("req_end_date"),
    )
    kept = ["record_type", "record_value", *land.COMMON, "req_location_id", "req_data_type", "data_delta"]
    return land.explode_records_qubeyond(docs).select(*kept)


@query("explode_records_embedded", _wide())
def q_embedded(t: Tables) -> DataFrame:
    docs = wide_documents(t).select(obj(customers=F.col("customers"), suppliers=F.col("suppliers"), header=F.col("header")).alias("_embedded"), *land.COMMON)
    return land.explode_records_embedded(docs)


# ---- text payloads routed by file name ----------------------------------------------


def payloads(t: Tables) -> DataFrame:
    """Per nation the JSON arrays of its customers, page by page, and the nation itself as one object."""
    customers = t.read("customer").groupBy(F.col("c_nationkey").alias("n"), page("c_custkey")).agg(
        F.to_json(F.collect_list(obj(id=F.col("c_custkey"), tags=F.array(F.col("c_mktsegment"))))).alias("value")
    ).select("n", F.lit("many").alias("kind"), "value")
    nation = t.read("nation").select(F.col("n_nationkey").alias("n"), F.lit("one").alias("kind"), F.to_json(obj(title=F.col("n_name"))).alias("value"))
    return customers.unionByName(nation)


MANY = """'{"id":' || c_custkey || ',"tags":["' || c_mktsegment || '"]}'"""
ONE = """'{"title":"' || n_name || '"}'"""


@query(
    "route_text_parbrink",
    f"""SELECT 'customers' AS record_type, {MANY} AS record_value, 'loc' || c_nationkey AS location_id FROM customer
        UNION ALL SELECT 'options', {ONE}, 'loc' || n_nationkey FROM nation""",
)
def q_parbrink(t: Tables) -> DataFrame:
    kind = F.when(F.col("kind") == "many", "customers").otherwise("options")
    files = payloads(t).select(
        "value", text("location=loc", F.col("n"), "/day=1/", kind, "_2024_01.json").alias("file_name"), F.lit(FEED_DATE).alias("feed_date"), F.lit("s1").alias("source_id")
    )
    return land.route_text_parbrink(files).select("record_type", "record_value", "location_id")


@query(
    "route_text_toast",
    f"""SELECT 'orders' AS record_type, {MANY} AS record_value, 'loc' || c_nationkey AS location_id FROM customer
        UNION ALL SELECT 'restaurants', {ONE}, NULL FROM nation
        UNION ALL SELECT 'menus', '[' || string_agg({MANY}, ',' ORDER BY c_custkey) || ']', NULL FROM customer GROUP BY c_nationkey, c_custkey // {PAGE_KEYS}""",
)
def q_toast(t: Tables) -> DataFrame:
    whole = t.read("customer").groupBy(F.col("c_nationkey").alias("n"), page("c_custkey")).agg(
        F.to_json(F.array_sort(F.collect_list(obj(id=F.col("c_custkey"), tags=F.array(F.col("c_mktsegment")))))).alias("value")
    ).select("n", "value")
    kind = F.when(F.col("kind") == "many", "orders").otherwise("restaurants")
    rows = payloads(t).select("n", kind.alias("kind"), "value").unionByName(whole.withColumn("kind", F.lit("menus")))
    files = rows.select(
        "value", text("a/b/c/d/e/f/g/", F.col("kind"), "/restaurant=loc", F.col("n"), "/x.json").alias("file_name"), F.lit(FEED_DATE).alias("feed_date"), F.lit("s1").alias("source_id")
    )
    return land.route_text_toast(files).select("record_type", "record_value", "location_id")


@query(
    "split_csv_payload",
    f"SELECT {cycle_sql('c_custkey', chr(39) + 'zip_merch' + chr(39), chr(39) + 'state' + chr(39))} AS record_type, c_name AS record_value, '{FEED_DATE}' AS feed_date FROM customer",
)
def q_csv(t: Tables) -> DataFrame:
    key = cust_key()
    files = t.read("customer").select(
        F.when(key % 2 == 0, F.col("c_name")).alias("line a"), F.when(key % 2 == 1, F.col("c_name")).alias("line_b"),
        text("202102_abc_", cycle(key, "zip_merch", "state"), ".csv.gz").alias("file_name"), F.lit(FEED_DATE).alias("feed_date"), F.lit("s1").alias("source_id"),
    )
    return land.split_csv_payload(files).select("record_type", "record_value", "feed_date")


@query(
    "split_device_ping",
    f"""SELECT event_id, {cycle_sql('event_id', "'AAID'", "'IDFA'", "'WEB'")} AS id_type, CASE event_id % 3 WHEN 0 THEN 'ad' || user_id END AS "advertiser_id_AAID",
               CASE event_id % 3 WHEN 1 THEN 'ad' || user_id END AS "advertiser_id_IDFA", CASE event_id % 3 WHEN 2 THEN 'ad' || user_id END AS "advertiser_id_UNKNOWN",
               CASE event_id % 4 WHEN 0 THEN '10.0.0.' || user_id END AS ipv_4, CASE WHEN event_id % 4 IN (1, 2) THEN 'fe80::' || user_id END AS ipv_6 FROM events""",
)
def q_ping(t: Tables) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    pings = t.read("events").select(
        "event_id", cycle(e, "aaid", "idfa", "web").alias("id_type"), text("ad", u).alias("ad_id"),
        cycle(e, text("10.0.0.", u), text("fe80::", u), text("fe80::", u), None).alias("ip_address"),
    )
    return land.split_device_ping(pings)
