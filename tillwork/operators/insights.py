"""Market, item and category insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.functions.fields import qualified_identity
from tillwork.functions.text_match import matching_names
from tillwork.operators.changes import restrict_to
from tillwork.operators.keyed import first_per_key, merge_conditional

ORDER_KEY = ["ord_id", "partner_id", "location_id"]
NON_POS_TYPES = [codes.PERSON_ID, codes.MAID_AAID, codes.MAID_IDFA]
# fixed values: item names and a pattern of item names that are no food of their own, and the types of food
EXCLUDED_NAMES = ["Small", "Large", "Medium", "Spicy", "Plain", "null", ""]
EXCLUDED_PATTERN = "^([Aa][Dd][Dd]|[Nn][Oo][Tt]?|[Ss][Ii][Dd][Ee]|[Ss][Uu][Bb]|[Ee][Xx][Tt][Rr][Aa]|[Ll][Ii][Gg][Hh][Tt]) |^[0-9]+ [Oo][Zz]$"
FOOD_TYPES = "[Ff][Oo][Oo][Dd]|Normal"


def completed_orders_by_location(orders: DataFrame, locations: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Completed orders (of the given dates, if any) with their store's place."""
    done = orders.filter(F.col("ord_state_id") == codes.ORDER_STATE["Completed"])
    if dates is not None:
        done = restrict_to(done, dates)
    return done.join(locations, ["partner_id", "location_id"]).select(
        "partner_id",
        codes.location_type_name(F.col("location_type")).alias("location_type"),
        "region",
        F.upper("state_code").alias("state"),
        F.initcap("city").alias("city"),
        "location_id",
        "location_nm",
        "ord_date",
        "ord_pay_total",
        "ord_id",
    )


def partner_market_insights(orders: DataFrame) -> DataFrame:
    """Amount and number of orders per store and day, each order counted once."""
    once = first_per_key(orders, ["partner_id", "location_id", "ord_date", "ord_id"], ["ord_pay_total", "location_nm"])
    return once.groupBy(
        "partner_id", "location_type", "region", "state", "city", "location_id", F.col("ord_date").alias("date")
    ).agg(
        F.min("location_nm").alias("location_nm"),
        F.sum("ord_pay_total").alias("transaction_amount"),
        F.count("ord_id").cast("int").alias("transaction_quantity"),
    )


def total_market_insights(partner_insights: DataFrame) -> DataFrame:
    return partner_insights.groupBy("location_type", "region", "state", "city", "date").agg(
        F.sum("transaction_amount").alias("transaction_amount"),
        F.sum("transaction_quantity").alias("transaction_quantity"),
    )


def total_market_from_feed(feed: DataFrame, published: DataFrame, full: bool = False) -> DataFrame:
    """Feed sums by cuisine category and place, less the rows already published."""
    sums = feed.groupBy(
        F.col("cuisine_category").alias("location_type"), "region", "state", "city", "date"
    ).agg(
        F.sum("transaction_amount").alias("transaction_amount"),
        F.sum("transaction_quantity").alias("transaction_quantity"),
    )
    return sums if full else sums.subtract(published.select(*sums.columns))


def food_items(items: DataFrame) -> DataFrame:
    """Sellable food: not a variation, a size word, an add-on phrase or a bare volume."""
    name = F.col("item_nm")
    return items.filter(
        F.col("item_type").rlike(FOOD_TYPES)
        & name.isNotNull()
        & ~name.isin(EXCLUDED_NAMES)
        & ~name.rlike(EXCLUDED_PATTERN)
    )


def customer_identities(customer_360: DataFrame, drop_types: list[str] | None = None) -> DataFrame:
    """(customer_360_id, qualified_identity) of active customers."""
    pairs = customer_360.filter("active_flag").select(
        "customer_360_id", F.explode("identities").alias("identity_type", "ids")
    )
    if drop_types:
        pairs = pairs.filter(~F.col("identity_type").isin(drop_types))
    return pairs.select("customer_360_id", F.col("identity_type"), F.explode("ids").alias("identity_id")).select(
        "customer_360_id", qualified_identity(F.col("identity_type"), F.col("identity_id")).alias("qualified_identity")
    )


def order_identity_rows(orders: DataFrame, *columns: str) -> DataFrame:
    """One row per order and identity, orders taken once whatever their line count."""
    wanted = list(dict.fromkeys([*ORDER_KEY, *columns]))
    return (
        orders.select(*wanted, F.explode("identity_ids").alias("i"))
        .select(*wanted, qualified_identity(F.col("i.identity_type"), F.col("i.identity_id")).alias("qualified_identity"))
        .distinct()
    )


def customer_of_order(orders: DataFrame, identities: DataFrame, unmatched: bool = False) -> DataFrame:
    """Each order with its smallest matching customer id; the many lines stay out of the join."""
    matched = order_identity_rows(orders).join(identities, "qualified_identity", "left" if unmatched else "inner")
    return matched.groupBy(*ORDER_KEY).agg(F.min("customer_360_id").alias("customer_360_id"))


def item_sales_enrich(lines: DataFrame, locations: DataFrame, items: DataFrame, customer_360: DataFrame) -> DataFrame:
    """Completed food lines with place and customer, one row per order and item name."""
    done = lines.filter(F.col("ord_state_id") == codes.ORDER_STATE["Completed"])
    food = food_items(items).select("item_id", "partner_id", "item_nm").distinct()
    sold = done.join(food, ["partner_id", "item_id"]).select(
        "ord_id", "ord_date", "partner_id", "location_id", "item_nm", "item_quantity", "item_total"
    )
    # an order's lines repeat its identities: once per order before they are unnested
    buyers = customer_of_order(done.select(*ORDER_KEY, "identity_ids").distinct(), customer_identities(customer_360, NON_POS_TYPES), unmatched=True)
    once = first_per_key(sold, ["ord_id", "ord_date", "partner_id", "location_id", "item_nm"])
    places = locations.select("partner_id", "location_id", "region", "state_code", "city", "location_nm")
    return once.join(buyers, ORDER_KEY).join(places, ["partner_id", "location_id"], "left")


def partner_item_insights(sales: DataFrame) -> DataFrame:
    return sales.groupBy(
        "ord_date", "partner_id", "region", "state_code", "city", "location_id", "location_nm",
        F.col("item_nm").alias("pos_item_nm"),
    ).agg(
        F.count("ord_id").alias("transaction_quantity"),  # an order comes once per item name
        F.sum("item_quantity").alias("item_quantity"),
        F.sum("item_total").alias("item_total"),
        F.array_sort(F.collect_set("customer_360_id")).alias("customer_360_ids"),
    )


def item_category_match(items: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Categories of every taxonomy name a food item matches; 'Unknown' when none does.

    taxonomy: item_nm, item_categories (array).
    """
    names = food_items(items).select("partner_id", F.col("item_nm").alias("pos_item_nm")).distinct()
    matches = matching_names(names.select("pos_item_nm"), taxonomy.select("item_nm"))
    categories = taxonomy.select(F.col("item_nm").alias("right_name"), F.explode("item_categories").alias("item_category"))
    by_name = (
        matches.join(categories, "right_name")
        .select(F.col("left_name").alias("pos_item_nm"), "item_category")
        .distinct()
    )
    return names.join(by_name, "pos_item_nm", "left").select(
        "partner_id", F.coalesce("item_category", F.lit("Unknown")).alias("item_category"), "pos_item_nm"
    )


def item_universe_merge(universe: DataFrame, matched: DataFrame) -> DataFrame:
    """Upsert that keeps what users edited; new rows start unedited."""
    return merge_conditional(
        universe,
        matched,
        ["partner_id", "item_category", "pos_item_nm"],
        update={"updated_on": F.col("s_updated_on")},
        insert={
            "item_category_modified": F.lit(None).cast("string"),
            "item_nm_modified": F.lit(None).cast("string"),
            "is_category_modified": F.lit(False),
            "is_item_modified": F.lit(False),
        },
    )


def category_insights_source(item_insights: DataFrame, universe: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Item insights under the category and name of the item universe, edits first."""
    rows = item_insights if dates is None else restrict_to(item_insights, dates)
    return rows.join(universe, ["partner_id", "pos_item_nm"]).select(
        "ord_date", "partner_id", "region", "state_code", "city", "location_id", "location_nm",
        "transaction_quantity", "item_quantity", "item_total",
        F.coalesce("item_category_modified", "item_category").alias("item_category"),
        F.coalesce("item_nm_modified", "pos_item_nm").alias("item_nm"),
    )


def partner_category_insights(source: DataFrame) -> DataFrame:
    return source.groupBy(
        "ord_date", "partner_id", "region", "state_code", "city", "location_id", "location_nm", "item_category"
    ).agg(
        F.sum("transaction_quantity").alias("transaction_quantity"),
        F.sum("item_quantity").alias("item_quantity"),
        F.sum("item_total").alias("item_total"),
    )
