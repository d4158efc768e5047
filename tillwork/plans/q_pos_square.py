"""Queries of the Square profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.identity_table import identity_partition_write
from tillwork.operators.pos import common, square
from tillwork.operators.privacy import with_identity_metadata
from tillwork.plans import pos_raw as raw
from tillwork.plans.bindings import FEED_DATE, SALT, Tables
from tillwork.plans.q_changes import scratch
from tillwork.plans.q_feeds import MARKET_VIEWS, postal_codes
from tillwork.plans.q_fields import cycle_sql
from tillwork.plans.registry import query
from tillwork.plans.sql_views import first_row

P = "p1"


def identities_text(df: DataFrame) -> DataFrame:
    joined = F.array_join(F.transform("identity_ids", lambda i: F.concat_ws(":", i["identity_type"], i["identity_id"])), "|")
    return df.withColumn("identity_ids", joined)


POSTAL_VIEWS = {"postal_codes": MARKET_VIEWS["postal_codes"]}
POS_VIEWS = {
    **POSTAL_VIEWS,
    "doc": """SELECT o_orderkey AS k, o_custkey AS cu, 'loc' || (o_orderkey % 25) AS loc, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                     o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS ts FROM orders""",
    "docline": """SELECT doc.*, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, CAST(l_quantity AS INTEGER) AS q,
                         CAST(round(l_extendedprice * 100) AS BIGINT) AS lc, l_partkey || '-' || l_suppkey || '-' || l_linenumber AS uid
                  FROM doc JOIN lineitem ON l_orderkey = k""",
}


def by_order_sql(identities: str) -> str:
    """Sorted 'type:id|...' per order."""
    return f"SELECT ord_id, location_id, string_agg(type || ':' || identity_id, '|' ORDER BY type, identity_id) AS identity_ids FROM ({identities}) WHERE ord_id IS NOT NULL GROUP BY ALL"


ZIP_SQL = cycle_sql("n_nationkey", "CAST(n_nationkey + 10000 AS VARCHAR)", "CAST(n_nationkey + 10000 AS VARCHAR)", "NULL")
SQUARE_IDENTITIES = f"""
    SELECT DISTINCT CAST(k AS VARCHAR) AS ord_id, loc AS location_id, identity_id, type, weight FROM (
        SELECT k, loc, 'hmail' || cu AS identity_id, 'email' AS type, 3 AS weight FROM doc WHERE cu % 5 <> 0
        UNION ALL SELECT k, loc, 'hphone' || cu, 'phone', 3 FROM doc WHERE cu % 4 <> 0
        UNION ALL SELECT k, loc, 'pick' || cu || '@x.com', 'email', 3 FROM doc WHERE k % 5 = 0
        UNION ALL SELECT k, loc, sha256('400000-' || (k % 9 + 1) || '-2030-visa-' || lpad(CAST(cu % 10000 AS VARCHAR), 4, '0') || '{SALT}'), 'combination-bin', 2
                  FROM doc WHERE k % 6 <> 0 AND k % 2 = 0
        UNION ALL SELECT k, loc, sha256(CASE WHEN k % 4 = 0 THEN 'jane doe' ELSE 'ann' || cu || '/lee' END || '-' || (k % 9 + 1) || '-2030-visa-' || lpad(CAST(cu % 10000 AS VARCHAR), 4, '0') || '{SALT}'), 'combination-card', 2
                  FROM doc WHERE k % 6 <> 0 AND (k % 4 = 0 OR cu % 6 <> 0)) WHERE k % 4 <= 1"""


@query(
    "locations_square",
    f"""SELECT 'loc' || n_nationkey AS location_id, n_name AS location_nm, {cycle_sql('n_nationkey', '1', '6', '99', '0')}::BIGINT AS location_type,
               {cycle_sql('n_nationkey', '0', '1', '1')}::BIGINT AS active_flg, 'Street ' || n_nationkey AS address_1, {ZIP_SQL} AS zip_code,
               strftime(DATE '2020-01-01' + n_nationkey, '%Y-%m-%d') || ' 10:00:00' AS open_dt, city, state_code, region
        FROM nation LEFT JOIN postal_codes ON postal_code = {ZIP_SQL}""",
    POSTAL_VIEWS,
)
def q_locations(t: Tables) -> DataFrame:
    table = square.locations(raw.square_locations(t), postal_codes(t), P, FEED_DATE)
    return table.select("location_id", "location_nm", "location_type", "active_flg", "address_1", "zip_code", "open_dt", "city", "state_code", "region")


@query("categories_square", "SELECT DISTINCT p_type AS cat_id, p_type[1] || lower(p_type[2:]) AS cat_nm, CAST(NULL AS VARCHAR) AS location_id, 'p1' AS partner_id, CAST(NULL AS VARCHAR) AS cat_desc FROM part")
def q_categories(t: Tables) -> DataFrame:
    return common.project_records(raw.square_objects(t), square.CATEGORIES, P, FEED_DATE)


@query(
    "items_square",
    f"""SELECT 'i' || p_partkey AS item_id, p_name AS item_nm, p_brand AS item_desc, 'food' AS item_type, p_type || '|' || p_brand AS category_array,
               CASE WHEN p_partkey % 5 <> 0 THEN 'v' || p_partkey END AS variation_array FROM part
        UNION ALL SELECT 'v' || p_partkey, 'Big ' || p_name, NULL, {cycle_sql('p_partkey', "'variation'", "'food'", "'unknown'")}, NULL, NULL FROM part WHERE p_partkey % 5 <> 0""",
)
def q_items(t: Tables) -> DataFrame:
    table = common.project_records(raw.square_objects(t), square.ITEMS, P, FEED_DATE)
    return table.select("item_id", "item_nm", "item_desc", "item_type", "category_array", "variation_array")


@query(
    "taxes_square",
    "SELECT DISTINCT 'p1' AS partner_id, loc AS location_id, 'tax' || (k % 7) AS tax_id, 'Tax ' || (k % 7) AS tax_nm, CAST(k % 7 AS VARCHAR) AS tax_rate, 'ADDITIVE' AS tax_type FROM doc",
    POS_VIEWS,
)
def q_taxes(t: Tables) -> DataFrame:
    return common.project_records(raw.square_orders(t), square.TAXES, P, FEED_DATE)


@query(
    "tenders_square",
    f"SELECT 'p1' AS partner_id, loc AS location_id, 't' || k AS tender_id, {cycle_sql('k', '2', '1', '99')}::BIGINT AS tender_type, CAST(NULL AS VARCHAR) AS tender_nm FROM doc",
    POS_VIEWS,
)
def q_tenders(t: Tables) -> DataFrame:
    return common.project_records(raw.square_orders(t), square.TENDERS, P, FEED_DATE)


@query(
    "payments_square",
    f"""SELECT 'p1' AS partner_id, 't' || k AS payment_id, CAST(k AS VARCHAR) AS order_id, loc AS location_id, 'COMPLETED' AS status,
               {cycle_sql('k', "'Jane Doe '", "'CARDHOLDER/VISA'", "''", 'NULL')} AS name, 'VISA' AS card_brand, lpad(CAST(cu % 10000 AS VARCHAR), 4, '0') AS pan,
               CASE WHEN k % 2 = 0 THEN '400000' END AS bin, CASE WHEN k % 6 <> 0 THEN CAST(k % 9 + 1 AS VARCHAR) END AS exp_month, '2030' AS exp_year FROM doc""",
    POS_VIEWS,
)
def q_payments(t: Tables) -> DataFrame:
    return common.project_records(raw.square_payments(t), square.PAYMENTS, P, FEED_DATE)


@query(
    "customers_square",
    """SELECT 'C' || c_custkey AS customer_id, CASE WHEN c_custkey % 3 = 0 THEN 'old' WHEN c_custkey % 5 <> 0 THEN 'hmail' || c_custkey END AS email_address,
              CASE WHEN c_custkey % 4 <> 0 THEN 'hphone' || c_custkey END AS phone_number, '2020-01-01 00:00:00' AS created_at, CAST(c_custkey % 3 AS VARCHAR) AS version FROM customer""",
)
def q_customers(t: Tables) -> DataFrame:
    """Every third customer is known already and stays as it is."""
    fresh = common.project_records(raw.square_customers(t), square.CUSTOMERS, P, FEED_DATE)
    stored = fresh.filter(F.substring("customer_id", 2, 20).cast("bigint") % 3 == 0).withColumn("email_address", F.lit("old"))
    table = square.customers(raw.square_customers(t), stored, P, FEED_DATE)
    return table.select("customer_id", "email_address", "phone_number", "created_at", "version")


def identities(t: Tables, records: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """From the given records of orders, or those of the tables."""
    known = common.project_records(raw.square_customers(t), square.CUSTOMERS, P, FEED_DATE)
    payments = common.project_records(raw.square_payments(t), square.PAYMENTS, P, FEED_DATE)
    return square.identities(raw.square_orders(t) if records is None else records, known, payments, FEED_DATE, SALT)


@query("identities_square", f"SELECT * REPLACE (CAST(weight AS BIGINT) AS weight) FROM ({SQUARE_IDENTITIES})", POS_VIEWS)
def q_identities(t: Tables) -> DataFrame:
    return identities(t)[0]


@query("identities_by_order", by_order_sql(SQUARE_IDENTITIES), POS_VIEWS)
def q_by_order(t: Tables) -> DataFrame:
    return identities_text(common.identities_by_order(identities(t)[0]))


@query(
    "identity_partition_write",
    f"""SELECT DISTINCT identity_id, type, CAST(weight AS BIGINT) AS weight, '{FEED_DATE}' AS feed_date, 'run1' AS run_id, 'fresh' AS state FROM ({SQUARE_IDENTITIES})
        UNION ALL SELECT DISTINCT identity_id, type, weight, '2023-12-31', 'run0', 'stale' FROM ({SQUARE_IDENTITIES})""",
    POS_VIEWS,
)
def q_partition_write(t: Tables) -> DataFrame:
    """An earlier run stays; this run's partition is written, then replaced. The identities are found once for the three writes."""
    found, lookup = identities(t)
    path, kept = scratch(t, "identities"), scratch(t, "found")
    with_identity_metadata(found, lookup).drop("metadata").write.parquet(kept)
    rows = t.spark.read.parquet(kept)
    for day, run, state in (("2023-12-31", "run0", "stale"), (FEED_DATE, "run1", "stale"), (FEED_DATE, "run1", "fresh")):
        identity_partition_write(rows.withColumn("state", F.lit(state)), path, day, run)
    return t.spark.read.parquet(path)


ORDER_SELECT = [
    "ord_id", "location_id", "ord_date", "ord_timestamp", "ord_total", "ord_sub_total", "discount_amount", "ord_state_id", "ord_originate_channel_id",
    "ord_target_channel_id", "item_id", "item_quantity", "item_total", "guest_check_line_item_id", "taxes_id", "taxes_amount", "service_charge_amount",
    "total_taxes_amount", "total_tip_amount", "tender_ids", "feed_date", "identity_ids",
]
WHEN = "CASE WHEN k % 9 <> 0 THEN ts + INTERVAL 1 HOUR ELSE ts END"
SQUARE_LINES = first_row(f"SELECT *, {WHEN} AS seen FROM docline", "k, pk", "lc, q, uid")


@query(
    "orders_square",
    f"""SELECT CAST(k AS VARCHAR) AS ord_id, loc AS location_id, strftime(seen, '%Y-%m-%d') AS ord_date, strftime(seen, '%Y-%m-%d %H:%M:%S') AS ord_timestamp,
               CAST(cents AS DOUBLE) / 100 AS ord_total, CAST(cents - k % 300 - k % 200 - k % 100 AS DOUBLE) / 100 AS ord_sub_total, CAST(k % 500 AS DOUBLE) / 100 AS discount_amount,
               {cycle_sql('k', '4', '4', '1', '99')}::BIGINT AS ord_state_id, {cycle_sql('k', '5', '5', '6', '6', '1', '1')}::BIGINT AS ord_originate_channel_id,
               CASE WHEN k % 6 <= 3 THEN 4 WHEN k % 5 = 0 THEN 3 ELSE 0 END::BIGINT AS ord_target_channel_id, 'i' || pk AS item_id, CAST(q AS DOUBLE) AS item_quantity,
               CAST(lc AS DOUBLE) / 100 AS item_total, uid AS guest_check_line_item_id, 'tax' || (pk % 3) AS taxes_id, CAST(lc % 50 AS DOUBLE) / 100 AS taxes_amount,
               CAST(k % 100 AS DOUBLE) / 100 AS service_charge_amount, CAST(k % 300 AS DOUBLE) / 100 AS total_taxes_amount, CAST(k % 200 AS DOUBLE) / 100 AS total_tip_amount,
               't' || k AS tender_ids, '{FEED_DATE}' AS feed_date, b.identity_ids
        FROM ({SQUARE_LINES}) l LEFT JOIN ({by_order_sql(SQUARE_IDENTITIES)}) b ON b.ord_id = CAST(k AS VARCHAR) AND b.location_id = loc""",
    POS_VIEWS,
)
def q_orders(t: Tables) -> DataFrame:
    records = raw.stored(t, raw.square_orders(t))
    by_order = common.identities_by_order(identities(t, records)[0])
    return identities_text(square.orders(records, by_order, P, FEED_DATE, stored=True)).select(*ORDER_SELECT)
