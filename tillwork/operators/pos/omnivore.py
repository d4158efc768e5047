"""Omnivore profile: everything but the locations comes from tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes, fields
from tillwork.operators.pos import common as c

LOCATIONS = c.RecordSpec(
    "locations",
    "id STRING, display_name STRING, name STRING, website STRING, status STRING, address STRUCT<street1: STRING, street2: STRING, zip: STRING, "
    "country: STRING>, coordinates STRUCT<latitude: STRING, longitude: STRING>, phone STRING, timezone STRING, created_at STRING",
    {
        "location_id": "r.id",
        "location_nm": "coalesce(r.display_name, r.name)",
        "location_website": "r.website",
        "location_type": "'1'",
        "active_flg": "CASE WHEN upper(r.status) = 'ONLINE' THEN '1' ELSE '0' END",
        "address_1": "r.address.street1",
        "address_2": "r.address.street2",
        "zip_code": lambda: fields.zip_code(F.col("r.address.zip")),
        "lat": "r.coordinates.latitude",
        "long": "r.coordinates.longitude",
        "phone": "r.phone",
        "country_code": "r.address.country",
        "timezone": "coalesce(r.timezone, 'UTC')",
        "currency": "'USD'",
        "open_dt": lambda: fields.epoch_timestamp(F.col("r.created_at")),
    },
    key=("location_id",),
    nulls=c.strings("fax", "parent_location_id", "extended_attr"),
)

_LINKS = "_links STRUCT<self: STRUCT<href: STRING>>"
_PAYMENTS = (
    "payments: ARRAY<STRUCT<id: STRING, type: STRING, last4: STRING, full_name: STRING, _embedded: STRUCT<tender_type: STRUCT<id: STRING, name: STRING>>>>"
)
_MENU = "menu_item: STRUCT<barcodes: ARRAY<STRING>, _embedded: STRUCT<menu_categories: ARRAY<STRUCT<id: STRING, name: STRING>>>>"
MENU_SCHEMA = f"{_LINKS}, _embedded STRUCT<items: ARRAY<STRUCT<id: STRING, name: STRING, _embedded: STRUCT<modifiers: ARRAY<STRUCT<id: STRING>>, {_MENU}>>>>"
PAYMENT_SCHEMA = f"id STRING, `open` STRING, `void` STRING, {_LINKS}, _embedded STRUCT<{_PAYMENTS}>"
ORDER_SCHEMA = (
    f"id STRING, `open` STRING, `void` STRING, opened_at STRING, closed_at STRING, {_LINKS}, "
    "totals STRUCT<total: STRING, discounts: STRING, service_charges: STRING, tax: STRING, tips: STRING, sub_total: STRING, paid: STRING>, "
    "_embedded STRUCT<order_type: STRUCT<id: STRING, name: STRING>, employee: STRUCT<id: STRING>, "
    "payments: ARRAY<STRUCT<_embedded: STRUCT<tender_type: STRUCT<id: STRING>>>>, "
    "items: ARRAY<STRUCT<id: STRING, price: STRING, quantity: STRING, included_tax: STRING>>>"
)
LOCATION_OF_URL = "get(split(r._links.self.href, '/'), 5)"

CATEGORIES = c.RecordSpec(
    "tickets",
    MENU_SCHEMA,
    {"cat_id": "m.id", "cat_nm": "m.name", "location_id": LOCATION_OF_URL},
    explode=(("m", "flatten(r._embedded.items._embedded.menu_item._embedded.menu_categories)"),),
    key=("cat_id", "location_id"),
    nulls=c.strings("cat_desc"),
)

_CATEGORY_NAMES = "x._embedded.menu_item._embedded.menu_categories.name"
_ALL_NAMES = f"upper(concat_ws(',', {_CATEGORY_NAMES}))"
ITEMS = c.RecordSpec(
    "tickets",
    MENU_SCHEMA,
    {
        "item_id": "x.id",
        "item_nm": "x.name",
        "category_array": _CATEGORY_NAMES,
        "item_type": "CASE WHEN size(x._embedded.modifiers) > 0 THEN 'VARIATION' ELSE 'FOOD' END",
        "main_category_name": f"CASE WHEN contains({_ALL_NAMES}, 'FOOD') THEN 'FOOD' WHEN contains({_ALL_NAMES}, 'DRINKS') THEN 'DRINKS' ELSE array_min({_CATEGORY_NAMES}) END",
        "item_barcode": "concat_ws(',', x._embedded.menu_item.barcodes)",
        "variation_array": "x._embedded.modifiers.id",
    },
    explode=(("x", "r._embedded.items"),),
    key=("item_id",),
    nulls=c.strings("item_desc", "item_plu"),
)

TENDERS = c.RecordSpec(
    "tickets",
    PAYMENT_SCHEMA,
    {
        "tender_id": "x._embedded.tender_type.id",
        "location_id": LOCATION_OF_URL,
        "tender_nm": "x._embedded.tender_type.name",
        "tender_type": lambda: codes.conform_text(F.col("x._embedded.tender_type.name"), codes.OMNIVORE_TENDER),
    },
    explode=(("x", "r._embedded.payments"),),
    key=("location_id", "tender_id"),
)

PAYMENTS = c.RecordSpec(
    "tickets",
    PAYMENT_SCHEMA,
    {"payment_id": "x.id", "order_id": "r.id", "location_id": LOCATION_OF_URL, "name": "x.type"},
    explode=(("x", "r._embedded.payments"),),
    key=("location_id", "order_id", "payment_id"),
    nulls=c.strings("status", "card_brand", "pan", "bin", "exp_month", "exp_year"),
)

LANDING = c.readers(LOCATIONS, CATEGORIES, ITEMS, TENDERS, PAYMENTS, ("tickets", ORDER_SCHEMA))


def locations(raw: DataFrame, postal_codes: DataFrame, partner_id: str, feed_date: str) -> DataFrame:
    return c.with_place(c.project_records(raw, LOCATIONS, partner_id, feed_date), postal_codes)


def orders(raw: DataFrame, by_order: DataFrame, partner_id: str, feed_date: str) -> DataFrame:
    """One row per ticket item; the time is the closing, else the opening."""
    def money(path: str):
        return lambda: fields.cents_to_money(F.col(path))

    when = F.coalesce("r.closed_at", "r.opened_at")
    return c.order_table(
        c.parsed(raw, "tickets", ORDER_SCHEMA, feed_date), isinstance(raw, c.TypedLanding), by_order,
        {
            "ord_id": "r.id",
            "ord_total": money("r.totals.total"),
            "ord_pay_total": money("r.totals.paid"),
            "ord_sub_total": money("r.totals.sub_total"),
            "ord_date": lambda: fields.epoch_timestamp(when),
            "ord_timestamp": lambda: fields.epoch_timestamp(when),
            "partner_id": lambda: F.lit(partner_id),
            "location_id": LOCATION_OF_URL,
            "ord_state_id": lambda: codes.omnivore_state(F.col("r.open"), F.col("r.void")),
            "ord_type": lambda: F.to_json("r._embedded.order_type"),
            "ord_originate_channel_id": lambda: codes.omnivore_originate(F.col("r._embedded.order_type.name")),
            "ord_target_channel_id": lambda: codes.omnivore_target(F.col("r._embedded.order_type.name")),
            "emp_id": "r._embedded.employee.id",
            "discount_amount": money("r.totals.discounts"),
            "service_charge_amount": money("r.totals.service_charges"),
            "total_taxes_amount": money("r.totals.tax"),
            "total_tip_amount": money("r.totals.tips"),
            "tender_ids": "r._embedded.payments._embedded.tender_type.id",
        },
        feed_date,
        ("x", "r._embedded.items"),
        {
            "item_id": "x.id",
            "item_quantity": "x.quantity",
            "item_total": money("x.price"),
            "taxes_amount": money("x.included_tax"),
        },
        ["item_total", "item_quantity"],
    )


def identities(raw: DataFrame, feed_date: str, salt: str) -> tuple[DataFrame, DataFrame]:
    """Name, tender and last four digits of the payments of closed, valid tickets."""
    done = c.parsed(raw, "tickets", PAYMENT_SCHEMA, feed_date).filter("r.open = 'false' AND r.void = 'false'")
    paid = c.exploded(done, ("x", "r._embedded.payments")).select(
        F.col("r.id").alias("ord_id"), F.expr(LOCATION_OF_URL).alias("location_id"),
        c.joined_key(F.coalesce("x.full_name", F.lit("")), F.col("x._embedded.tender_type.name"), F.col("x.last4")).alias("_card"),
    )
    return c.hash_weak(c.identity_rows(paid, c.identity(F.col("_card"), codes.CARD_SLIM, 2)), salt)
