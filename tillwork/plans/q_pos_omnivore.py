"""Queries of the Omnivore profile."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwork.operators.pos import common, omnivore
from tillwork.plans import pos_raw as raw
from tillwork.plans.bindings import FEED_DATE, SALT, Tables
from tillwork.plans.q_feeds import postal_codes
from tillwork.plans.q_fields import cycle_sql
from tillwork.plans.q_pos_square import ORDER_SELECT, POS_VIEWS, POSTAL_VIEWS, P, ZIP_SQL, by_order_sql, identities_text
from tillwork.plans.registry import query
from tillwork.plans.sql_views import first_row

CATEGORY = "(['Fast food', 'Soft drinks', 'Zest', 'Bakery', 'Grill', 'Ale'])"


@query(
    "locations_omnivore",
    f"""SELECT 'loc' || n_nationkey AS location_id, CASE WHEN n_nationkey % 2 = 0 THEN 'Shown ' || n_nationkey ELSE n_name END AS location_nm,
               CASE WHEN n_nationkey % 2 = 0 THEN '1' ELSE '0' END AS active_flg, {ZIP_SQL} AS zip_code,
               CASE WHEN n_nationkey % 3 = 0 THEN 'America/Denver' ELSE 'UTC' END AS timezone,
               strftime(DATE '2020-01-01' + n_nationkey, '%Y-%m-%d') || ' 00:00:00' AS open_dt, city, state_code, region
        FROM nation LEFT JOIN postal_codes ON postal_code = {ZIP_SQL}""",
    POSTAL_VIEWS,
)
def q_locations(t: Tables) -> DataFrame:
    table = omnivore.locations(raw.omnivore_locations(t), postal_codes(t), P, FEED_DATE)
    return table.select("location_id", "location_nm", "active_flg", "zip_code", "timezone", "open_dt", "city", "state_code", "region")


@query(
    "categories_omnivore",
    f"""SELECT DISTINCT 'cat' || (pk % 6) AS cat_id, {CATEGORY}[pk % 6 + 1] AS cat_nm, loc AS location_id FROM docline
        UNION SELECT 'cat9', 'Menu', loc FROM docline""",
    POS_VIEWS,
)
def q_categories(t: Tables) -> DataFrame:
    return common.project_records(raw.omnivore_tickets(t), omnivore.CATEGORIES, P, FEED_DATE).select("cat_id", "cat_nm", "location_id")


@query(
    "items_omnivore",
    f"""SELECT DISTINCT 'i' || pk AS item_id, 'Dish ' || pk AS item_nm, {CATEGORY}[pk % 6 + 1] || '|Menu' AS category_array,
               CASE WHEN pk % 4 = 0 THEN 'VARIATION' ELSE 'FOOD' END AS item_type,
               CASE pk % 6 WHEN 0 THEN 'FOOD' WHEN 1 THEN 'DRINKS' WHEN 2 THEN 'Menu' ELSE least({CATEGORY}[pk % 6 + 1], 'Menu') END AS main_category_name,
               'b' || pk || ',c' || pk AS item_barcode, CASE WHEN pk % 4 = 0 THEN 'm' || pk ELSE '' END AS variation_array FROM docline""",
    POS_VIEWS,
)
def q_items(t: Tables) -> DataFrame:
    table = common.project_records(raw.omnivore_tickets(t), omnivore.ITEMS, P, FEED_DATE)
    return table.select("item_id", "item_nm", "category_array", "item_type", "main_category_name", "item_barcode", "variation_array")


@query(
    "tenders_omnivore",
    f"""SELECT DISTINCT 'p1' AS partner_id, 'tt' || (k % 4) AS tender_id, loc AS location_id, {cycle_sql('k', "'Card'", "'Cash'", "'3rd Party'", "'Coupon'")} AS tender_nm,
               {cycle_sql('k', '2', '1', '99', '99')}::BIGINT AS tender_type FROM doc WHERE k % 6 <> 0""",
    POS_VIEWS,
)
def q_tenders(t: Tables) -> DataFrame:
    return common.project_records(raw.omnivore_tickets(t), omnivore.TENDERS, P, FEED_DATE)


@query(
    "payments_omnivore",
    "SELECT 'pay' || k AS payment_id, CAST(k AS VARCHAR) AS order_id, loc AS location_id, 'card_present' AS name, CAST(NULL AS VARCHAR) AS pan FROM doc WHERE k % 6 <> 0",
    POS_VIEWS,
)
def q_payments(t: Tables) -> DataFrame:
    table = common.project_records(raw.omnivore_tickets(t), omnivore.PAYMENTS, P, FEED_DATE)
    return table.select("payment_id", "order_id", "location_id", "name", "pan")


TICKET_IDENTITIES = f"""
    SELECT CAST(k AS VARCHAR) AS ord_id, loc AS location_id,
           sha256(CASE WHEN k % 2 = 0 THEN 'al ' || cu ELSE '' END || '-' || {cycle_sql('k', "'card'", "'cash'", "'3rd party'", "'coupon'")} || '-' || (cu % 1000) || '{SALT}') AS identity_id,
           'combination-card-slim' AS type, 2 AS weight
    FROM doc WHERE k % 6 <> 0 AND k % 3 <> 0 AND k % 5 >= 2"""


@query("identities_omnivore", f"SELECT * REPLACE (CAST(weight AS BIGINT) AS weight) FROM ({TICKET_IDENTITIES})", POS_VIEWS)
def q_identities(t: Tables) -> DataFrame:
    return omnivore.identities(raw.omnivore_tickets(t), FEED_DATE, SALT)[0]


SEEN = "CASE WHEN k % 9 <> 0 THEN ts + INTERVAL 1 HOUR ELSE ts END"
TICKET_LINES = first_row(f"SELECT *, {SEEN} AS seen FROM docline", "k, pk", "lc, q")
COLUMNS = [c for c in ORDER_SELECT if c not in ("taxes_id", "guest_check_line_item_id")] + ["emp_id", "ord_type"]


@query(
    "orders_omnivore",
    f"""SELECT CAST(k AS VARCHAR) AS ord_id, loc AS location_id, strftime(seen, '%Y-%m-%d') AS ord_date, strftime(seen, '%Y-%m-%d %H:%M:%S') AS ord_timestamp,
               CAST(cents AS DOUBLE) / 100 AS ord_total, CAST(cents - k % 300 AS DOUBLE) / 100 AS ord_sub_total, CAST(k % 500 AS DOUBLE) / 100 AS discount_amount,
               {cycle_sql('k', '1', '3', '4', '4', '4')}::BIGINT AS ord_state_id, {cycle_sql('k', '1', '1', '1', '99', '99', '0', '0')}::BIGINT AS ord_originate_channel_id,
               {cycle_sql('k', '1', '1', '3', '4', '1', '0', '0')}::BIGINT AS ord_target_channel_id, 'i' || pk AS item_id, CAST(q AS DOUBLE) AS item_quantity,
               CAST(lc AS DOUBLE) / 100 AS item_total, CAST(lc % 50 AS DOUBLE) / 100 AS taxes_amount, CAST(k % 100 AS DOUBLE) / 100 AS service_charge_amount,
               CAST(k % 300 AS DOUBLE) / 100 AS total_taxes_amount, CAST(k % 200 AS DOUBLE) / 100 AS total_tip_amount,
               CASE WHEN k % 6 = 0 THEN '' ELSE 'tt' || (k % 4) END AS tender_ids, '{FEED_DATE}' AS feed_date, b.identity_ids, 'e' || (k % 11) AS emp_id,
               '{{"id":"ot' || (k % 7) || '"' || coalesce(',"name":"' || {cycle_sql('k', "'Dine In'", "'Eat In'", "'Carry Out'", "'Delivery'", "'Order Ahead'", "'Other'", 'NULL')} || '"', '') || '}}' AS ord_type
        FROM ({TICKET_LINES}) l LEFT JOIN ({by_order_sql(TICKET_IDENTITIES)}) b ON b.ord_id = CAST(k AS VARCHAR) AND b.location_id = loc""",
    POS_VIEWS,
)
def q_orders(t: Tables) -> DataFrame:
    by_order = common.identities_by_order(omnivore.identities(raw.omnivore_tickets(t), FEED_DATE, SALT)[0])
    return identities_text(omnivore.orders(raw.omnivore_tickets(t), by_order, P, FEED_DATE)).select(*COLUMNS)
