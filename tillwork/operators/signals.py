"""Transactional signals: one-hot order metrics, daily pre-aggregation, trailing periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes, fields
from tillwork.operators.changes import restrict_to
from tillwork.operators.insights import ORDER_KEY, customer_identities, customer_of_order
from tillwork.operators.keyed import first_per_key

SEPARATOR = "__SEP__"

# ---- fixed values: signals of each domain ----
TENDER_METRICS = "tender_type_metrics"
ORDER_METRICS = "order_metrics"
TIME_METRICS = "time_of_day_metrics"
HOUR_METRICS = "hour_of_day_metrics"
CHANNEL_METRICS = "channel_metrics"
SIGNALS = {
    TENDER_METRICS: ["card", "cash", "gift_card", "wallet"],
    ORDER_METRICS: ["total_orders", "total_amount"],
    TIME_METRICS: ["early_morning", "late_morning", "early_afternoon", "late_afternoon", "early_night", "late_night"],
    HOUR_METRICS: [f"{h:02d}_{(h + 1) % 24:02d}" for h in range(24)],
    CHANNEL_METRICS: [
        "unknown_channel", "physical_lane", "physical_kiosk", "physical_pickup", "physical_delivery",
        "digital_web", "digital_app", "other_channel",
    ],
}
CHANNEL_SIGNAL = {
    0: "unknown_channel", 1: "physical_lane", 2: "physical_kiosk", 3: "physical_pickup",
    4: "physical_delivery", 5: "digital_web", 6: "digital_app", 99: "other_channel",
}
TENDER_SIGNAL = {1: "cash", 2: "card", 3: "gift_card", 4: "wallet"}


def metric_column(domain: str, signal: str) -> str:
    return domain + SEPARATOR + signal


def metric_columns(*domains: str) -> list[str]:
    return [metric_column(d, s) for d in (domains or SIGNALS) for s in SIGNALS[d]]


def orders_local_time(orders: DataFrame, locations: DataFrame) -> DataFrame:
    """Order time as wall clock of the store, and the date that gives."""
    zones = locations.select("partner_id", "location_id", "timezone")
    local = fields.local_time(F.col("ord_timestamp"), F.col("timezone"))
    joined = orders.join(zones, ["partner_id", "location_id"], "left")
    return joined.withColumns({"ord_timestamp": local, "ord_date": local.cast("date")}).select(*orders.columns)


def drop_null_keys(orders: DataFrame) -> DataFrame:
    return orders.dropna(subset=["ord_date", "partner_id", "location_id", "identity_ids"])


def one_hot_metrics(df: DataFrame, signal: Column, domain: str) -> DataFrame:
    """A 0/1 column for every signal of the domain, added in one projection."""
    return df.select(
        "*",
        *[
            F.when(signal == s, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(metric_column(domain, s))
            for s in SIGNALS[domain]
        ],
    )


def metric_orders(orders: DataFrame) -> DataFrame:
    """One order, and its amount in cents cut off (not rounded) as a double gives it."""
    cents = (F.col("ord_pay_total").cast("double") * 100).cast("bigint")
    return orders.select(
        "*",
        F.lit(1).cast("bigint").alias(metric_column(ORDER_METRICS, "total_orders")),
        cents.alias(metric_column(ORDER_METRICS, "total_amount")),
    )


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 8), "early_morning")
        .when(hour.between(9, 11), "late_morning")
        .when(hour.between(12, 15), "early_afternoon")
        .when(hour.between(16, 19), "late_afternoon")
        .when(hour >= 20, "early_night")
        .when(hour.isNotNull(), "late_night")
    )


def metric_time_of_day(orders: DataFrame) -> DataFrame:
    return one_hot_metrics(orders, time_of_day(F.hour("ord_timestamp")), TIME_METRICS)


def metric_hour_of_day(orders: DataFrame) -> DataFrame:
    hour = F.hour("ord_timestamp")
    return one_hot_metrics(orders, F.format_string("%02d_%02d", hour, (hour + 1) % 24), HOUR_METRICS)


def channel_signal(originate: Column, target: Column) -> Column:
    """The physical target decides; else a physical origin; else web and app mean delivery."""
    start, end = codes.lookup(originate, CHANNEL_SIGNAL), codes.lookup(target, CHANNEL_SIGNAL)
    vague = ["unknown_channel", "other_channel"]
    on_site = ["physical_lane", "physical_kiosk"]
    digital = ["digital_web", "digital_app"]
    return F.coalesce(
        F.when(start.isin(on_site) & end.isin(vague), start)
        .when(start.isin(vague + on_site + digital) & end.isin(on_site + ["physical_pickup", "physical_delivery"]), end)
        .when(start.isin(digital) & end.isin(vague), F.lit("physical_delivery")),
        F.lit("unknown_channel"),
    )


def metric_channel(orders: DataFrame) -> DataFrame:
    signal = channel_signal(F.col("ord_originate_channel_id"), F.col("ord_target_channel_id"))
    return one_hot_metrics(orders, signal, CHANNEL_METRICS)


def metric_tender(orders: DataFrame, tenders: DataFrame) -> DataFrame:
    """Number of tenders of each kind per order, 0 where there is none."""
    names = metric_columns(TENDER_METRICS)
    kinds = one_hot_metrics(
        tenders.filter(F.col("tender_type").isNotNull()), codes.lookup(F.col("tender_type"), TENDER_SIGNAL), TENDER_METRICS
    ).select("tender_id", *names)
    used = orders.select("ord_id", F.explode("tender_ids").alias("tender_id"))
    per_order = used.join(kinds, "tender_id").groupBy("ord_id").agg(*[F.sum(n).alias(n) for n in names])
    return orders.join(per_order, "ord_id", "left").fillna(0, subset=names)


def with_all_metrics(orders: DataFrame, tenders: DataFrame) -> DataFrame:
    staged = metric_tender(orders, tenders)
    for step in (metric_orders, metric_time_of_day, metric_hour_of_day, metric_channel):
        staged = step(staged)
    return staged


def signals_grouping_sets(
    orders_with_metrics: DataFrame, identities: DataFrame, *domains: str, orders: DataFrame | None = None
) -> DataFrame:
    """Metric sums by customer, partner, day and store, and over all stores as _ALL.

    orders, when given, are the same orders without metrics, so that finding their customers
    does not compute the metrics a second time.
    """
    names = metric_columns(*domains)
    once = first_per_key(
        orders_with_metrics.select(*ORDER_KEY, "ord_date", *names), ORDER_KEY, ["ord_date", *names]
    )
    buyers = customer_of_order(orders_with_metrics if orders is None else orders, identities)
    rows = once.join(buyers, ORDER_KEY)
    keys = ["customer_360_id", "partner_id", "ord_date"]
    sums = [F.sum(n).alias(n) for n in names]
    stores = rows.groupBy(*keys, "location_id").agg(*sums)  # the sums add up, so only these rows are doubled for _ALL
    scopes = F.explode(F.array("location_id", F.lit(codes.ALL_LOCATIONS)))
    return stores.withColumn("location_id", scopes).groupBy(*keys, "location_id").agg(*sums).select(*keys, "location_id", *names)


def signals_unpivot(wide: DataFrame, *domains: str) -> DataFrame:
    """Long rows (domain, name, value) without the zeros."""
    cells = F.array(
        *[
            F.struct(F.lit(d).alias("signal_domain"), F.lit(s).alias("signal_name"), F.col(metric_column(d, s)).alias("signal_value"))
            for d in (domains or SIGNALS)
            for s in SIGNALS[d]
        ]
    )
    kept = F.filter(cells, lambda c: c["signal_value"] != 0)
    return wide.select("ord_date", "customer_360_id", "partner_id", "location_id", F.inline(kept))


def preaggr_signals(
    orders: DataFrame, tenders: DataFrame, locations: DataFrame, customer_360: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Daily signals of all orders, or of the changed (local) dates only."""
    local = drop_null_keys(orders_local_time(orders, locations))
    if dates is not None:
        local = restrict_to(local, dates)
    metrics = with_all_metrics(local, tenders)
    return signals_unpivot(signals_grouping_sets(metrics, customer_identities(customer_360), orders=local))


def period_signals(daily: DataFrame, feed_date: str) -> DataFrame:
    """Sums over the trailing 7, 30, 60 and 90 days in one pass over the daily signals."""
    end = dt.date.fromisoformat(feed_date)
    starts = {p: (end - dt.timedelta(days=n - 1)).isoformat() for p, n in codes.PERIODS.items()}
    day, value = F.col("ord_date"), F.col("signal_value")
    recent = daily.filter(day.between(F.lit(min(starts.values())).cast("date"), F.lit(feed_date).cast("date")))
    sums = recent.groupBy("customer_360_id", "partner_id", "location_id", "signal_domain", "signal_name").agg(
        *[F.sum(F.when(day >= F.lit(s).cast("date"), value)).alias(p) for p, s in starts.items()]
    )
    cells = F.array(*[F.struct(F.lit(p).alias("date_option"), F.col(p).alias("signal_value")) for p in starts])
    return sums.select(
        "customer_360_id", "partner_id", "location_id", "signal_domain", "signal_name",
        F.inline(F.filter(cells, lambda c: c["signal_value"].isNotNull())),
    )


# ---- trailing periods from running totals ----

SIGNAL_KEY = ["customer_360_id", "partner_id", "location_id", "signal_domain", "signal_name"]


def extend_totals(totals: DataFrame | None, daily: DataFrame, day: str, after: str | None = None) -> DataFrame:
    """Running totals as of `day`: per signal the sum and the number of all daily values up to and with it.

    totals: those as of an earlier day, whose date is `after`; daily: the daily signals, of which only the days after it are read.
    Without totals all days up to `day` count. A key's total is one row, whatever its history.
    """
    new = daily.filter(F.col("ord_date") <= F.lit(day).cast("date"))
    if after is not None:
        new = new.filter(F.col("ord_date") > F.lit(after).cast("date"))
    rows = new.groupBy(*SIGNAL_KEY).agg(F.sum("signal_value").alias("total"), F.count("signal_value").alias("days"))
    if totals is not None:
        rows = rows.unionByName(totals.select(*rows.columns))
        rows = rows.groupBy(*SIGNAL_KEY).agg(F.sum("total").alias("total"), F.sum("days").alias("days"))
    return rows.withColumn("as_of", F.lit(day).cast("date"))


def edge_days(feed_date: str) -> dict[str, str]:
    """For each trailing period the day before its first."""
    end = dt.date.fromisoformat(feed_date)
    return {p: (end - dt.timedelta(days=n)).isoformat() for p, n in codes.PERIODS.items()}


def period_signals_from_totals(totals: DataFrame, feed_date: str) -> DataFrame:
    """What period_signals gives, from running totals of the feed date and of the day before each period.

    Each period is the difference of two totals, so a run reads five days of the totals (partitioned by as_of) instead of
    90 days of signals. A period without a daily value gives no row.
    """
    edges = edge_days(feed_date)
    wanted = [F.lit(d).cast("date") for d in (feed_date, *edges.values())]
    sign = F.when(F.col("as_of") == wanted[0], 1).otherwise(-1)
    sums = totals.filter(F.col("as_of").isin(*wanted)).groupBy(*SIGNAL_KEY).agg(
        *[
            F.sum(F.when(F.col("as_of").isin(wanted[0], F.lit(d).cast("date")), F.col(c) * sign)).alias(f"{p}_{c}")
            for p, d in edges.items() for c in ("total", "days")
        ]
    )
    cells = F.array(*[F.struct(F.lit(p).alias("date_option"), F.col(f"{p}_total").alias("signal_value"), F.col(f"{p}_days").alias("days")) for p in edges])
    listed = sums.select(*SIGNAL_KEY, F.inline(F.filter(cells, lambda c: c["days"] > 0)))
    return listed.drop("days")
