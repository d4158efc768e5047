"""Customer signals from person attributes and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes

# fixed values: attribute -> published signal name, all in the domain "profile"
PROFILE = "profile"
ATTRIBUTE_SIGNALS = {
    "gender": "gender", "income": "income", "age_range": "age_range", "age": "age", "occupation": "occupation",
    "children": "children", "new_credit_range": "new_credit_range", "credit_ranges": "credit_ranges",
    "children_interests": "children_interests", "education_code": "education_code", "home_owner": "home_owner",
    "net_worth": "net_worth", "marital_status": "marital_status", "pets": "pets",
    "pets_own_at_least_one_cat": "pets_cat", "pets_own_at_least_one_dog": "pets_dog", "language": "language",
}
PLACE_SIGNALS = {"zip_code": "zip_code", "location": "location"}


def customers_with_person_id(customer_360: DataFrame) -> DataFrame:
    """(customer_360_id, person_id) of the active customers."""
    return customer_360.filter("active_flag").select(
        "customer_360_id", F.explode(F.element_at("identities", F.lit(codes.PERSON_ID))).alias("person_id")
    )


def person_signals(customers: DataFrame, attributes: DataFrame, signals: dict[str, str], feed_date: str) -> DataFrame:
    """One value per customer and signal, the smallest as text, for all signals in one pass."""
    cells = F.array(
        *[F.struct(F.lit(name).alias("signal_name"), F.col(column).cast("string").alias("signal_value")) for column, name in signals.items()]
    )
    rows = customers.join(attributes.select("person_id", *signals), "person_id").select("customer_360_id", F.inline(cells))
    return rows.filter(F.col("signal_value").isNotNull()).groupBy("customer_360_id", "signal_name").agg(
        F.min("signal_value").alias("signal_value")
    ).select(
        "customer_360_id", F.lit(feed_date).cast("date").alias("signal_generation_date"),
        F.lit(PROFILE).alias("signal_domain"), "signal_name", "signal_value",
    )


def demographic_signals(customers: DataFrame, attributes: DataFrame, feed_date: str) -> DataFrame:
    present = {c: n for c, n in ATTRIBUTE_SIGNALS.items() if c in attributes.columns}
    return person_signals(customers, attributes, present, feed_date)


def geographic_signals(customers: DataFrame, person_geo: DataFrame, postal_codes: DataFrame, feed_date: str) -> DataFrame:
    """Zip code and 'lat,lng' of the person's postal code."""
    places = postal_codes.select(F.col("postal_code").alias("zip_code"), F.concat("lat", F.lit(","), "lng").alias("location"))
    return person_signals(customers, person_geo.join(places, "zip_code", "left"), PLACE_SIGNALS, feed_date)
