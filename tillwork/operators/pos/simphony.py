"""Simphony profile; the raw table carries the store as loc_ref."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.keyed import first_per_key, with_group_maximum
from tillwork.operators.pos import common as c
from tillwork.session import stored_once

LOCATIONS = c.RecordSpec(
    "locations",
    "locRef STRING, active STRING, name STRING",
    {
        "location_id": "r.locRef",
        "location_nm": "r.name",
        "active_flg": "CASE WHEN r.active = 'true' THEN 1 ELSE 0 END",
    },
    key=("location_id",),
    nulls={
        **c.strings(
            "address_1", "address_2", "city", "state", "lat", "long", "phone", "fax", "country_code", "parent_location_id",
            "currency", "timezone", "region", "zip_code", "extended_attr",
        ),
        "location_type": "int",
        "open_dt": "timestamp",
    },
)

MENU_ITEM = "num STRING, name STRING, majGrpNum STRING, majGrpName STRING, famGrpNum STRING"
ITEMS = c.RecordSpec(
    "menuItems",
    MENU_ITEM,
    {
        "item_id": "r.num",
        "item_nm": "r.name",
        "main_category_id": "r.majGrpNum",
        "main_category_name": "r.majGrpName",
        "sub_category_id": "r.famGrpNum",
    },
    key=("item_id",),
    nulls=c.strings("item_plu", "item_barcode"),
)
CATEGORIES = c.RecordSpec(
    "menuItems",
    MENU_ITEM,
    {"cat_id": "r.majGrpNum", "location_id": "loc_ref", "cat_nm": "r.majGrpName"},
    key=("cat_id", "location_id"),
    nulls=c.strings("cat_desc"),
)
ITEM_PRICES = c.RecordSpec(
    "menuItemPrices",
    "num STRING, effFrDt STRING, prcLvlNum STRING, price STRING, rvcNum STRING",
    {
        "item_id": "r.num",
        "location_id": "loc_ref",
        "eff_fr_dt": "r.effFrDt",
        "prc_lvl_id": "r.prcLvlNum",
        "price": "r.price",
        "rvc_id": "r.rvcNum",
    },
    key=("item_id", "location_id"),
    nulls=c.strings("eff_to_dt", "prc_lvl_name", "amount", "weight", "measurement_unit", "weight_price", "cost"),
)
TAXES = c.RecordSpec(
    "taxes",
    "num STRING, name STRING, taxRate STRING, type STRING",
    {"tax_id": "r.num", "location_id": "loc_ref", "tax_nm": "r.name", "tax_rate": "r.taxRate", "tax_type": "r.type"},
    key=("location_id", "tax_id"),
)
DISCOUNTS = c.RecordSpec(
    "discounts",
    "num STRING, name STRING, posPercent STRING",
    {"discount_id": "r.num", "location_id": "loc_ref", "discount_nm": "r.name", "percentage": "r.posPercent"},
    key=("location_id", "discount_id"),
)
SERVICE_CHARGES = c.RecordSpec(
    "serviceCharges",
    "num STRING, name STRING, posPercent STRING",
    {"srvc_charge_id": "r.num", "location_id": "loc_ref", "srvc_charge_nm": "r.name", "srvc_charge_type": "r.posPercent"},
    key=("location_id", "srvc_charge_id"),
)

CHECK = (
    "chkNum STRING, chkName STRING, chkTtl STRING, opnBusDt STRING, opnUTC STRING, clsdFlag STRING, empNum STRING, guestCheckId STRING, "
    "payTtl STRING, subTtl STRING, detailLines ARRAY<STRUCT<aggQty: STRING, aggTtl: STRING, discount: STRING, dspQty: STRING, dspTtl: STRING, "
    "lineNum: STRING, menuItem: STRUCT<activeTaxes: STRING, miNum: STRING, prcLvl: STRING>, tenderMedia: STRUCT<tmedNum: STRING, name: STRING>, "
    "rsnCodeNum: STRING, svcRndNum: STRING>>"
)
TENDERS = c.RecordSpec(
    "guestChecks",
    CHECK,
    {"tender_id": "x.tenderMedia.tmedNum", "location_id": "loc_ref", "tender_nm": "x.tenderMedia.name"},
    explode=(("x", "r.detailLines"),),
    where="x.tenderMedia.tmedNum IS NOT NULL",
    key=("location_id", "tender_id"),
    nulls={"tender_type": "int"},
)

LANDING = c.readers(LOCATIONS, ITEMS, CATEGORIES, ITEM_PRICES, TAXES, DISCOUNTS, SERVICE_CHARGES, TENDERS, ("guestChecks", CHECK))


def orders(raw: DataFrame, partner_id: str, feed_date: str) -> DataFrame:
    """One row per guest-check line with an item; its tender is the check's largest among them."""
    money = "decimal(12,2)"
    sold = "filter(r.detailLines, x -> x.menuItem.miNum IS NOT NULL)"
    checks = c.parsed(raw, "guestChecks", CHECK, feed_date).select(
        F.col("r.chkNum").alias("ord_id"), F.col("r.chkName").alias("ord_desc"), F.col("r.chkTtl").try_cast(money).alias("ord_total"),
        F.col("r.opnBusDt").try_cast("date").alias("ord_date"), F.try_to_timestamp("r.opnUTC").alias("ord_timestamp"),
        F.lit(partner_id).alias("partner_id"), F.col("loc_ref").alias("location_id"), F.col("r.clsdFlag").alias("ord_state"),
        F.col("r.empNum").alias("emp_id"), F.col("r.guestCheckId").alias("customer_id"),
        F.col("r.payTtl").try_cast(money).alias("ord_pay_total"), F.col("r.subTtl").try_cast(money).alias("ord_sub_total"),
        F.expr(sold).alias("_lines"), F.expr(f"array_max(transform({sold}, x -> x.tenderMedia.tmedNum))").alias("_tender"),
    )
    if isinstance(raw, c.TypedLanding):  # a check that comes once and names no line twice has its own tender and nothing to choose
        once, again = c.once_and_again(checks, [F.col("ord_id"), F.col("location_id")], F.col("_lines")["lineNum"])
        return _lines_of(once.withColumnRenamed("_tender", "tender_id")).unionByName(_chosen(again))
    return _chosen(checks)


def _chosen(checks: DataFrame) -> DataFrame:
    """What a check's lines share, its tender among it, is made once per check; a line is the smallest of its copies."""
    check = ["ord_id", "ord_date", "ord_timestamp", "partner_id", "location_id"]
    totals = with_group_maximum(checks, check, "tender_id", "_tender", lambda groups: stored_once(groups, "tenders")).drop("_tender")
    return first_per_key(_lines_of(totals), ["partner_id", "location_id", "ord_id", "ord_date", "line_id"], ["item_id", "item_total"])


def _lines_of(checks: DataFrame) -> DataFrame:
    money = "decimal(12,2)"
    return checks.withColumn("x", F.explode("_lines")).select(
        "ord_id", "ord_desc", "ord_total", "ord_date", "ord_timestamp", "partner_id", "location_id", "ord_state",
        F.col("x.aggQty").try_cast("int").alias("item_quantity"), F.col("x.aggTtl").try_cast(money).alias("item_total"),
        "emp_id", F.col("x.discount").alias("discount_id"), F.col("x.dspQty").alias("dsp_qty"),
        F.col("x.dspTtl").alias("dsp_ttl"), F.col("x.lineNum").alias("line_id"), F.col("x.menuItem.activeTaxes").alias("taxes_id"),
        F.col("x.menuItem.miNum").alias("item_id"), F.col("x.menuItem.prcLvl").alias("item_price_id"),
        F.col("x.rsnCodeNum").alias("reason_code_id"), F.col("x.svcRndNum").alias("service_charge_id"),
        "customer_id", "ord_pay_total", "ord_sub_total",
        *[F.lit(None).cast("string").alias(n) for n in ("ord_type", "guest_check_line_item_id", "taxes_amount", "service_charge")],
        *[F.lit(None).cast("int").alias(n) for n in ("ord_originate_channel_id", "ord_target_channel_id")], "tender_id",
    )
