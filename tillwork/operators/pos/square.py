"""Square profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes, fields
from tillwork.operators.keyed import first_per_key, merge_insert_only
from tillwork.operators.pos import common as c

LOCATIONS = c.RecordSpec(
    "locations",
    "id STRING, name STRING, type STRING, status STRING, address STRUCT<address_line_1: STRING, postal_code: STRING, country: STRING>, "
    "coordinates STRUCT<latitude: STRING, longitude: STRING>, phone_number STRING, timezone STRING, currency STRING, "
    "created_at STRING, website_url STRING",
    {
        "location_id": "r.id",
        "location_nm": "r.name",
        "location_type": "CASE WHEN upper(r.type) = 'PHYSICAL' THEN 1 WHEN upper(r.type) = 'MOBILE' THEN 6 WHEN r.type IS NOT NULL THEN 99 ELSE 0 END",
        "active_flg": "CASE WHEN r.status = 'ACTIVE' THEN 1 ELSE 0 END",
        "address_1": "r.address.address_line_1",
        "zip_code": lambda: fields.zip_code(F.col("r.address.postal_code")),
        "lat": "r.coordinates.latitude",
        "long": "r.coordinates.longitude",
        "phone": "r.phone_number",
        "country_code": "r.address.country",
        "timezone": "r.timezone",
        "currency": "r.currency",
        "open_dt": lambda: fields.iso_timestamp(F.col("r.created_at")),
        "location_website": "r.website_url",
    },
    key=("location_id",),
    nulls=c.strings("address_2", "fax", "parent_location_id", "extended_attr"),
)

CATEGORIES = c.RecordSpec(
    "objects",
    "id STRING, type STRING, category_data STRUCT<name: STRING>",
    {"cat_id": "r.id", "cat_nm": "r.category_data.name"},
    where="r.type = 'CATEGORY'",
    key=("cat_id", "location_id"),
    nulls=c.strings("cat_desc", "location_id"),
)

ITEMS = c.RecordSpec(
    "objects",
    "id STRING, type STRING, item_data STRUCT<name: STRING, description: STRING, category_id: STRING, "
    "variations: ARRAY<STRUCT<id: STRING, type: STRING, item_variation_data: STRUCT<name: STRING>>>>",
    {
        "item_id": "i.item_id",
        "item_nm": "i.item_nm",
        "item_desc": "i.item_desc",
        "item_type": "i.item_type",
        "category_array": "i.category_array",
        "variation_array": "i.variation_array",
    },
    where="r.type = 'ITEM'",
    explode=(
        (
            "i",
            """concat(
                array(named_struct('item_id', r.id, 'item_nm', r.item_data.name, 'item_desc', r.item_data.description, 'item_type', 'food',
                    'category_array', split(r.item_data.category_id, ','), 'variation_array', r.item_data.variations.id)),
                coalesce(transform(r.item_data.variations, v -> named_struct('item_id', v.id, 'item_nm', v.item_variation_data.name,
                    'item_desc', cast(null as string),
                    'item_type', CASE lower(v.type) WHEN 'item' THEN 'food' WHEN 'item_variation' THEN 'variation' ELSE 'unknown' END,
                    'category_array', cast(null as array<string>), 'variation_array', cast(null as array<string>))), array()))""",
        ),
    ),
    key=("item_id", "item_type"),
    nulls=c.strings("main_category_name", "item_plu", "item_barcode"),
)

TAXES = c.RecordSpec(
    "orders",
    "location_id STRING, taxes ARRAY<STRUCT<uid: STRING, name: STRING, percentage: STRING, type: STRING>>",
    {"location_id": "r.location_id", "tax_id": "x.uid", "tax_nm": "x.name", "tax_rate": "x.percentage", "tax_type": "x.type"},
    explode=(("x", "r.taxes"),),
    key=("location_id", "tax_id"),
)

TENDERS = c.RecordSpec(
    "orders",
    "location_id STRING, tenders ARRAY<STRUCT<id: STRING, type: STRING>>",
    {
        "location_id": "r.location_id",
        "tender_id": "x.id",
        "tender_type": lambda: codes.conform_text(F.col("x.type"), codes.SQUARE_TENDER),
    },
    explode=(("x", "r.tenders"),),
    key=("location_id", "tender_id"),
    nulls=c.strings("tender_nm"),
)

PAYMENTS = c.RecordSpec(
    "payments",
    "id STRING, order_id STRING, location_id STRING, status STRING, card_details STRUCT<card: STRUCT<cardholder_name: STRING, "
    "card_brand: STRING, last_4: STRING, bin: STRING, exp_month: STRING, exp_year: STRING>>",
    {
        "payment_id": "r.id",
        "order_id": "r.order_id",
        "location_id": "r.location_id",
        "status": "r.status",
        "name": "r.card_details.card.cardholder_name",
        "card_brand": "r.card_details.card.card_brand",
        "pan": "r.card_details.card.last_4",
        "bin": "r.card_details.card.bin",
        "exp_month": "r.card_details.card.exp_month",
        "exp_year": "r.card_details.card.exp_year",
    },
    key=("location_id", "order_id", "payment_id"),
)

CUSTOMERS = c.RecordSpec(
    "customers",
    "id STRING, email_address STRING, phone_number STRING, given_name STRING, family_name STRING, created_at STRING, version STRING",
    {
        "customer_id": "r.id",
        "email_address": "r.email_address",
        "phone_number": "r.phone_number",
        "first_name": "r.given_name",
        "last_name": "r.family_name",
        "created_at": lambda: fields.iso_timestamp(F.col("r.created_at")),
        "version": "r.version",
    },
    key=("customer_id",),
)

ORDER_SCHEMA = (
    "id STRING, location_id STRING, state STRING, created_at STRING, closed_at STRING, customer_id STRING, source STRUCT<name: STRING>, "
    "total_money STRUCT<amount: STRING>, total_discount_money STRUCT<amount: STRING>, total_service_charge_money STRUCT<amount: STRING>, "
    "total_tax_money STRUCT<amount: STRING>, total_tip_money STRUCT<amount: STRING>, discounts STRUCT<uid: STRING>, "
    "fulfillments ARRAY<STRUCT<state: STRING, type: STRING>>, tenders ARRAY<STRUCT<id: STRING>>, "
    "line_items ARRAY<STRUCT<uid: STRING, catalog_object_id: STRING, quantity: STRING, total_money: STRUCT<amount: STRING>, "
    "total_tax_money: STRUCT<amount: STRING>, applied_taxes: ARRAY<STRUCT<tax_uid: STRING>>>>"
)

IDENTITY_SCHEMA = (
    "id STRING, location_id STRING, state STRING, customer_id STRING, tenders ARRAY<STRUCT<id: STRING, customer_id: STRING>>, "
    "fulfillments ARRAY<STRUCT<pickup_details: STRUCT<recipient: STRUCT<email_address: STRING, phone_number: STRING>>>>"
)

LANDING = c.readers(LOCATIONS, CATEGORIES, ITEMS, TAXES, TENDERS, PAYMENTS, CUSTOMERS, ("orders", ORDER_SCHEMA), ("orders", IDENTITY_SCHEMA))


def locations(raw: DataFrame, postal_codes: DataFrame, partner_id: str, feed_date: str) -> DataFrame:
    return c.with_place(c.project_records(raw, LOCATIONS, partner_id, feed_date), postal_codes)


def customers(raw: DataFrame, stored: DataFrame, partner_id: str, feed_date: str) -> DataFrame:
    """Customer master: known customers are never changed."""
    fresh = c.project_records(raw, CUSTOMERS, partner_id, feed_date)
    return merge_insert_only(stored, fresh.select(*stored.columns), ["partner_id", "customer_id"])


def orders(raw: DataFrame, by_order: DataFrame, partner_id: str, feed_date: str, stored: bool = False) -> DataFrame:
    """One row per order line; the close time falls back to the creation time. stored: raw text is stored too (see order_table)."""
    def money(path: str):
        return lambda: fields.cents_to_money(F.col(path))

    when = "coalesce(r.closed_at, r.created_at)"
    lines = c.order_table(
        c.parsed(raw, "orders", ORDER_SCHEMA, feed_date), stored or isinstance(raw, c.TypedLanding), by_order,
        {
            "ord_id": "r.id",
            "ord_total": money("r.total_money.amount"),
            "ord_pay_total": money("r.total_money.amount"),
            "ord_date": lambda: fields.iso_timestamp(F.expr(when)),
            "ord_timestamp": lambda: fields.iso_timestamp(F.expr(when)),
            "discount_amount": money("r.total_discount_money.amount"),
            "discount_id": "r.discounts.uid",
            "partner_id": lambda: F.lit(partner_id),
            "location_id": "r.location_id",
            "ord_state_id": lambda: codes.conform_text(F.col("r.state"), codes.SQUARE_STATE),
            "ord_originate_channel_id": lambda: codes.square_originate(F.col("r.source.name")),
            "ord_target_channel_id": lambda: codes.square_target(F.col("r.source.name"), F.col("r.fulfillments")),
            "service_charge_amount": money("r.total_service_charge_money.amount"),
            "total_taxes_amount": money("r.total_tax_money.amount"),
            "total_tip_amount": money("r.total_tip_money.amount"),
            "tender_ids": "r.tenders.id",
        },
        feed_date,
        ("line", "r.line_items"),
        {
            "item_id": "line.catalog_object_id",
            "item_quantity": "line.quantity",
            "item_total": money("line.total_money.amount"),
            "guest_check_line_item_id": "line.uid",
            "taxes_id": "line.applied_taxes.tax_uid",
            "taxes_amount": money("line.total_tax_money.amount"),
        },
        ["item_total", "item_quantity", "guest_check_line_item_id"],
    )
    charges = F.col("total_taxes_amount") + F.col("total_tip_amount") + F.col("service_charge_amount")
    return lines.withColumn("ord_sub_total", (F.col("ord_total") - charges).cast("decimal(12,2)"))


def identities(raw: DataFrame, known_customers: DataFrame, payments: DataFrame, feed_date: str, salt: str) -> tuple[DataFrame, DataFrame]:
    """Customer and pickup contacts, and card combinations, of completed orders."""
    done = c.parsed(raw, "orders", IDENTITY_SCHEMA, feed_date).filter("r.state = 'COMPLETED'").select(
        F.col("r.id").alias("ord_id"), F.col("r.location_id").alias("location_id"), "r.customer_id", "r.tenders", "r.fulfillments"
    )
    paid = done.select("ord_id", "location_id", "customer_id", F.explode("tenders").alias("x")).select(
        "ord_id", "location_id", F.coalesce(F.nullif("customer_id", F.lit("")), "x.customer_id").alias("customer_id"),
        F.col("x.id").alias("payment_id"),
    )
    people = first_per_key(
        known_customers.select("customer_id", "email_address", "phone_number", "first_name", "last_name"), ["customer_id"]
    )
    cards = payments.select("payment_id", "name", "card_brand", "pan", "bin", "exp_month", "exp_year")
    full = paid.join(people, "customer_id", "left").join(cards, "payment_id", "left")
    named = F.when((F.col("name") != "") & ~F.col("name").contains("CARDHOLDER"), F.trim(F.lower("name")))
    holder = F.coalesce(named, c.first_last(F.col("first_name"), F.col("last_name")))
    from_payments = c.identity_rows(
        full,
        c.identity(F.col("email_address"), codes.EMAIL, 3),
        c.identity(F.col("phone_number"), codes.PHONE, 3),
        c.identity(c.card_bin_key(), codes.CARD_BIN, 2),
        c.identity(c.card_name_key(holder), codes.CARD_NAME, 2),
    )
    pickups = done.select("ord_id", "location_id", F.explode("fulfillments.pickup_details.recipient").alias("p"))
    from_pickups = c.identity_rows(
        pickups, c.identity(F.col("p.email_address"), codes.EMAIL, 3), c.identity(F.col("p.phone_number"), codes.PHONE, 3)
    )
    return c.hash_weak(from_payments.unionByName(from_pickups), salt)


