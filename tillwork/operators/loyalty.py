"""Loyalty types from recency, frequency and spend.

Everything starts from one row per customer, partner, scope and day, a scope being a store
or _ALL; several as-of dates are computed together, so the orders are read once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.functions.fields import qualified_identity
from tillwork.operators.keyed import first_per_key, with_group_totals

BLOCK_DAYS = 30
CUSTOMER = ["customer_360_id", "partner_id", "location_id"]


@dataclass(frozen=True)
class LoyaltyConfig:
    new_days: int
    loyal_days: int
    at_risk_days: int
    regular_days: int
    rfm_threshold: float


def _shift(day: str, days: int) -> str:
    return (dt.date.fromisoformat(day) + dt.timedelta(days=days)).isoformat()


def _date(day: str) -> Column:
    return F.lit(day).cast("date")


def orders_by_customer(orders: DataFrame, identities: DataFrame) -> DataFrame:
    """Each order once for every customer one of its identities belongs to."""
    # an order's lines repeat it: once per order before its identities are unnested; of the rows that two identities give the smallest is taken anyway
    order = ["ord_id", "partner_id", "location_id", "ord_date", "ord_pay_total"]
    named = F.transform("identity_ids", lambda i: qualified_identity(i["identity_type"], i["identity_id"]))
    once = orders.dropna(subset=["identity_ids", "ord_date"]).select(*order, named.alias("_identities")).distinct()
    rows = once.select(*order, F.explode("_identities").alias("qualified_identity")).join(identities, "qualified_identity")
    return first_per_key(
        rows.drop("qualified_identity"), [*CUSTOMER, "ord_id"], ["ord_date", "ord_pay_total"]
    )


def customer_days(customer_orders: DataFrame) -> DataFrame:
    """Orders and spend per customer, partner, scope and day."""
    scoped = customer_orders.withColumn("location_id", F.explode(F.array("location_id", F.lit(codes.ALL_LOCATIONS))))
    return scoped.groupBy(*CUSTOMER, "ord_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("ord_pay_total").alias("amount")
    )


def _as_of(days: DataFrame, ends: list[str], length: int, column: str = "ord_date") -> DataFrame:
    """Rows repeated for every as-of date whose last `length` days contain them."""
    spans = F.array(*[F.struct(_date(e).alias("end"), _date(_shift(e, 1 - length)).alias("start")) for e in ends])
    hits = F.filter(spans, lambda s: F.col(column).between(s["start"], s["end"]))
    return days.withColumn("as_of", F.explode(F.transform(hits, lambda s: s["end"])))


def customer_activity(days: DataFrame, ends: list[str], length: int) -> DataFrame:
    """Per as-of date and customer: days to the last order, orders, spend, active blocks."""
    age = F.date_diff("as_of", "ord_date")
    in_block = [F.max(F.when((age >= BLOCK_DAYS * i) & (age < BLOCK_DAYS * (i + 1)), 1).otherwise(0)) for i in range(3)]
    return _as_of(days, ends, length).groupBy("as_of", *CUSTOMER).agg(
        (F.date_diff(F.max("ord_date"), F.max("as_of")) + (length - 1)).alias("days_to_txn"),
        F.sum("orders").alias("orders"),
        F.sum("amount").cast("double").alias("amount"),
        (in_block[0] * in_block[1] * in_block[2]).alias("txn_all_months"),
    )


def _scale(df: DataFrame, scores: dict[str, str]) -> DataFrame:
    """Min-max scale columns within as-of date, partner and scope; an empty range gives 1."""
    totals = {}
    for value in scores.values():
        totals[f"_min_{value}"] = ("min", F.col(value))
        totals[f"_max_{value}"] = ("max", F.col(value))
    ranged = with_group_totals(df, ["as_of", "partner_id", "location_id"], totals)
    return ranged.select(
        *df.columns,
        *[
            F.coalesce(
                F.try_divide(F.col(v) - F.col(f"_min_{v}"), F.col(f"_max_{v}") - F.col(f"_min_{v}")).cast("double"), F.lit(1.0)
            ).alias(name)
            for name, v in scores.items()
        ],
    )


def rfm_scores(days: DataFrame, ends: list[str], length: int) -> DataFrame:
    activity = customer_activity(days, ends, length)
    return _scale(
        activity, {"recency_score": "days_to_txn", "frequency_score": "orders", "monetary_score": "amount"}
    )


def rfm_loyalty(days: DataFrame, ends: list[str], length: int, threshold: float) -> DataFrame:
    """The summed scores scaled again; loyal above the threshold with all three blocks active."""
    scores = rfm_scores(days, ends, length).withColumn(
        "final_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    )
    scaled = _scale(scores, {"rfm_score": "final_score"})
    return scaled.withColumn("is_loyal", (F.col("rfm_score") > threshold) & (F.col("txn_all_months") == 1))


def loyal_customers(days: DataFrame, ends: list[str], length: int, threshold: float) -> DataFrame:
    return rfm_loyalty(days, ends, length, threshold).filter("is_loyal").select("as_of", *CUSTOMER)


def new_customers(days: DataFrame, ends: list[str], length: int) -> DataFrame:
    first = days.groupBy(*CUSTOMER).agg(F.min("ord_date").alias("oldest_order"))
    return _as_of(first, ends, length, "oldest_order").select("as_of", *CUSTOMER)


def at_risk_customers(loyal_now: DataFrame, loyal_before: DataFrame) -> DataFrame:
    """Loyal at the earlier date (already moved to its as_of), no longer loyal."""
    return loyal_before.join(loyal_now, ["as_of", *CUSTOMER], "left_anti")


def regular_customers(days: DataFrame, others: DataFrame, ends: list[str], length: int) -> DataFrame:
    active = _as_of(days, ends, length).select("as_of", *CUSTOMER).distinct()
    return active.join(others, ["as_of", *CUSTOMER], "left_anti")


def loyalty_at(days: DataFrame, ends: list[str], config: LoyaltyConfig) -> DataFrame:
    """The four loyalty types as of each date; a customer may be both NEW and LOYAL.

    Loyal rows carry the role they play (now, or before) for a date, and one aggregation per date and
    customer brings them together with the first order and the recent activity.
    """
    back = config.at_risk_days - 1
    roles: dict[str, list[Column]] = {}
    for e in ends:
        for day, role in ((e, "now"), (_shift(e, -back), "before")):
            roles.setdefault(day, []).append(F.struct(_date(e).alias("as_of"), F.lit(role == "now").alias("now"), F.lit(role == "before").alias("before")))
    plays = F.create_map(*[x for day, r in sorted(roles.items()) for x in (_date(day), F.array(*r))])
    loyal = loyal_customers(days, sorted(roles), config.loyal_days, config.rfm_threshold)
    loyal = loyal.select(*CUSTOMER, F.inline(plays[F.col("as_of")]))

    until = F.filter(F.array(*[_date(e) for e in ends]), lambda e: F.col("ord_date") <= e)
    recent = F.date_diff("as_of", "ord_date") < config.regular_days
    seen = days.select(*CUSTOMER, "ord_date", F.explode(until).alias("as_of")).groupBy("as_of", *CUSTOMER).agg(
        (F.date_diff(F.max("as_of"), F.min("ord_date")) < config.new_days).alias("new"), F.max(recent).alias("active")
    )
    no = F.lit(False)
    flags = seen.withColumns({"now": no, "before": no}).unionByName(loyal.withColumns({"new": no, "active": no}))
    status = flags.groupBy("as_of", *CUSTOMER).agg(*[F.max(f).alias(f) for f in ("new", "active", "now", "before")])
    at_risk = F.col("before") & ~F.col("now")
    types = F.array(
        F.when(F.col("new"), F.lit("NEW")), F.when(F.col("now"), F.lit("LOYAL")), F.when(at_risk, F.lit("AT_RISK")),
        F.when(F.col("active") & ~F.col("new") & ~F.col("now") & ~at_risk, F.lit("REGULAR")),
    )
    return status.select("as_of", *CUSTOMER, F.explode(F.array_compact(types)).alias("loyalty_type"))


def loyalty_types(customer_orders: DataFrame, feed_date: str, config: LoyaltyConfig) -> DataFrame:
    """Loyalty as of the feed date less 7, 30, 60 and 90 days, per store and over all stores."""
    ends = {_shift(feed_date, -n): period for period, n in codes.PERIODS.items()}
    typed = loyalty_at(customer_days(customer_orders), list(ends), config)
    return typed.select(
        *CUSTOMER,
        codes.lookup(F.date_format("as_of", "yyyy-MM-dd"), ends).alias("date_option"),
        F.col("loyalty_type").alias("signal_value"),
    )
