"""Queries of the Simphony profile."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwork.operators.pos import common, simphony
from tillwork.plans import pos_raw as raw
from tillwork.plans.bindings import FEED_DATE, Tables
from tillwork.plans.q_pos_square import POS_VIEWS, P
from tillwork.plans.registry import query
from tillwork.plans.sql_views import first_row


def master(t: Tables, spec: common.RecordSpec, *columns: str) -> DataFrame:
    return common.project_records(raw.simphony_masters(t), spec, P, FEED_DATE).select(*columns)


@query("locations_simphony", "SELECT 'loc' || n_nationkey AS location_id, n_name AS location_nm, CAST(n_nationkey % 3 <> 0 AS BIGINT) AS active_flg, CAST(NULL AS VARCHAR) AS city FROM nation")
def q_locations(t: Tables) -> DataFrame:
    return master(t, simphony.LOCATIONS, "location_id", "location_nm", "active_flg", "city")


@query("categories_simphony", "SELECT DISTINCT p_type AS cat_id, 'loc' || (p_partkey % 25) AS location_id, p_type[1] || lower(p_type[2:]) AS cat_nm FROM part")
def q_categories(t: Tables) -> DataFrame:
    return master(t, simphony.CATEGORIES, "cat_id", "location_id", "cat_nm")


@query(
    "items_simphony",
    "SELECT 'i' || p_partkey AS item_id, p_name AS item_nm, p_type AS main_category_id, p_type[1] || lower(p_type[2:]) AS main_category_name, p_brand AS sub_category_id FROM part",
)
def q_items(t: Tables) -> DataFrame:
    return master(t, simphony.ITEMS, "item_id", "item_nm", "main_category_id", "main_category_name", "sub_category_id")


@query(
    "item_prices_simphony",
    """SELECT 'i' || p_partkey AS item_id, 'loc' || (p_partkey % 25) AS location_id, '2020-01-01' AS eff_fr_dt, CAST(p_partkey % 3 AS VARCHAR) AS prc_lvl_id,
              p_retailprice AS price, CAST(p_partkey % 2 AS VARCHAR) AS rvc_id FROM part""",
)
def q_prices(t: Tables) -> DataFrame:
    table = master(t, simphony.ITEM_PRICES, "item_id", "location_id", "eff_fr_dt", "prc_lvl_id", "price", "rvc_id")
    return table.withColumn("price", table["price"].cast("double"))


STORES = "nation, (SELECT unnest([1, 2, 3, 4]) AS d)"


@query("taxes_simphony", f"SELECT CAST(d AS VARCHAR) AS tax_id, 'loc' || n_nationkey AS location_id, 'Tax ' || d AS tax_nm, CAST(CAST(d * 1.5 AS DOUBLE) AS VARCHAR) AS tax_rate, 'k' || (d % 2) AS tax_type FROM {STORES}")
def q_taxes(t: Tables) -> DataFrame:
    return master(t, simphony.TAXES, "tax_id", "location_id", "tax_nm", "tax_rate", "tax_type")


@query("discounts_simphony", f"SELECT CAST(d AS VARCHAR) AS discount_id, 'loc' || n_nationkey AS location_id, 'Entry ' || d AS discount_nm, CAST(d * 10 AS VARCHAR) AS percentage FROM {STORES}")
def q_discounts(t: Tables) -> DataFrame:
    return master(t, simphony.DISCOUNTS, "discount_id", "location_id", "discount_nm", "percentage")


@query(
    "service_charges_simphony",
    f"SELECT CAST(d AS VARCHAR) AS srvc_charge_id, 'loc' || n_nationkey AS location_id, 'Entry ' || d AS srvc_charge_nm, CAST(d * 10 AS VARCHAR) AS srvc_charge_type FROM {STORES}",
)
def q_charges(t: Tables) -> DataFrame:
    return master(t, simphony.SERVICE_CHARGES, "srvc_charge_id", "location_id", "srvc_charge_nm", "srvc_charge_type")


@query(
    "tenders_simphony",
    """SELECT DISTINCT loc AS location_id, 'tm' || m AS tender_id, 'Media ' || m AS tender_nm
       FROM (SELECT loc, k % 8 AS m FROM doc UNION SELECT loc, pk % 8 FROM docline WHERE pk % 2 = 0)""",
    POS_VIEWS,
)
def q_tenders(t: Tables) -> DataFrame:
    return common.project_records(raw.simphony_checks(t), simphony.TENDERS, P, FEED_DATE).select("location_id", "tender_id", "tender_nm")


LINES = first_row("SELECT *, max(CASE WHEN pk % 2 = 0 THEN 'tm' || (pk % 8) END) OVER (PARTITION BY k) AS tender_id FROM docline", "k, uid", "pk, lc")


COLUMNS = [
    "ord_id", "ord_desc", "ord_total", "ord_date", "ord_timestamp", "location_id", "ord_state", "item_quantity", "item_total", "emp_id", "discount_id", "line_id",
    "taxes_id", "item_id", "item_price_id", "service_charge_id", "tender_id", "customer_id", "ord_pay_total", "ord_sub_total",
]


@query(
    "orders_simphony",
    f"""SELECT CAST(k AS VARCHAR) AS ord_id, 'Check ' || k AS ord_desc, CAST(cents AS DOUBLE) / 100 AS ord_total, strftime(ts, '%Y-%m-%d') AS ord_date,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS ord_timestamp, loc AS location_id, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS ord_state, CAST(q AS BIGINT) AS item_quantity,
               CAST(lc AS DOUBLE) / 100 AS item_total, CAST(k % 11 AS VARCHAR) AS emp_id, 'd' || (pk % 4) AS discount_id, uid AS line_id, CAST(pk % 3 AS VARCHAR) AS taxes_id,
               'i' || pk AS item_id, CAST(pk % 2 AS VARCHAR) AS item_price_id, CAST(ln AS VARCHAR) AS service_charge_id, tender_id, 'g' || k AS customer_id,
               CAST(cents AS DOUBLE) / 100 AS ord_pay_total, CAST(cents - k % 300 AS DOUBLE) / 100 AS ord_sub_total FROM ({LINES})""",
    POS_VIEWS,
)
def q_orders(t: Tables) -> DataFrame:
    return simphony.orders(raw.simphony_checks(t), P, FEED_DATE).select(*COLUMNS)
