"""Queries of the transactional signals and of loyalty."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.operators import loyalty as loy
from tillwork.operators import signals as sig
from tillwork.operators.insights import customer_identities
from tillwork.operators.keyed import overwrite_where
from tillwork.plans.bindings import Tables
from tillwork.plans.registry import query
from tillwork.session import scratch_folder

FEED = "1996-03-31"

# ---- one-hot metrics in SQL ---------------------------------------------------------

TIME_SQL = """CASE WHEN h BETWEEN 5 AND 8 THEN 'early_morning' WHEN h BETWEEN 9 AND 11 THEN 'late_morning'
    WHEN h BETWEEN 12 AND 15 THEN 'early_afternoon' WHEN h BETWEEN 16 AND 19 THEN 'late_afternoon'
    WHEN h >= 20 THEN 'early_night' ELSE 'late_night' END"""
CHANNEL_SQL = """CASE WHEN o IN (1, 2) AND t IN (0, 99) THEN name_of[o + 1]
    WHEN o IN (0, 99, 1, 2, 5, 6) AND t IN (1, 2, 3, 4) THEN name_of[t + 1]
    WHEN o IN (5, 6) AND t IN (0, 99) THEN 'physical_delivery' ELSE 'unknown_channel' END"""
NAME_OF = "['unknown_channel', 'physical_lane', 'physical_kiosk', 'physical_pickup', 'physical_delivery', 'digital_web', 'digital_app']"
METRIC_VIEWS = {
    "local_orders": """
        SELECT r.* REPLACE (lt AS ord_timestamp, CAST(lt AS DATE) AS ord_date), hour(lt) AS h
        FROM (SELECT r.*, (ord_timestamp AT TIME ZONE 'UTC') AT TIME ZONE coalesce(l.timezone, 'UTC') AS lt
              FROM retail_orders r LEFT JOIN locations l ON l.partner_id = r.partner_id AND l.location_id = r.location_id) r""",
    "order_signals": f"""
        SELECT ord_id, 'time_of_day_metrics' AS d, {TIME_SQL} AS s, 1 AS v FROM local_orders
        UNION ALL SELECT ord_id, 'hour_of_day_metrics', lpad(CAST(h AS VARCHAR), 2, '0') || '_' || lpad(CAST((h + 1) % 24 AS VARCHAR), 2, '0'), 1 FROM local_orders
        UNION ALL SELECT ord_id, 'channel_metrics', {CHANNEL_SQL}, 1
                  FROM (SELECT ord_id, ord_originate_channel_id AS o, ord_target_channel_id AS t, {NAME_OF} AS name_of FROM local_orders)
        UNION ALL SELECT ord_id, 'order_metrics', 'total_orders', 1 FROM local_orders
        UNION ALL SELECT ord_id, 'order_metrics', 'total_amount', CAST(trunc(CAST(ord_pay_total AS DOUBLE) * 100) AS BIGINT) FROM local_orders
        UNION ALL SELECT ord_id, 'tender_type_metrics', (['cash', 'card', 'gift_card', 'wallet'])[tender_type], 1
                  FROM order_tenders JOIN tenders USING (tender_id) WHERE tender_type BETWEEN 1 AND 4""",
    "first_buyer": "SELECT ord_id, min(customer_360_id) AS customer_360_id FROM order_customers GROUP BY ord_id",
    "daily": """
        SELECT customer_360_id, partner_id, ord_date, location_id, d AS signal_domain, s AS signal_name, sum(v) AS signal_value
        FROM (SELECT b.customer_360_id, o.partner_id, o.ord_date, unnest([o.location_id, '_ALL']) AS location_id, g.d, g.s, g.v
              FROM local_orders o JOIN first_buyer b USING (ord_id) JOIN order_signals g USING (ord_id))
        GROUP BY ALL HAVING sum(v) <> 0""",
}


def local_orders(t: Tables) -> DataFrame:
    return sig.orders_local_time(t.retail_orders(), t.locations())


def _wide_sql(domain: str) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum(v) FILTER (d = '{domain}' AND s = '{s}'), 0) AS BIGINT) AS \"{sig.metric_column(domain, s)}\"" for s in sig.SIGNALS[domain]
    )
    return f"SELECT o.ord_id, {cells} FROM local_orders o LEFT JOIN order_signals g USING (ord_id) GROUP BY o.ord_id"


@query(
    "orders_local_time",
    "SELECT ord_id, strftime(ord_timestamp, '%Y-%m-%d %H:%M:%S') AS ord_timestamp, strftime(ord_date, '%Y-%m-%d') AS ord_date FROM local_orders",
    METRIC_VIEWS,
)
def q_orders_local_time(t: Tables) -> DataFrame:
    return local_orders(t).select("ord_id", "ord_timestamp", "ord_date")


@query(
    "drop_null_keys",
    "SELECT ord_id FROM retail_orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0",
)
def q_drop_null_keys(t: Tables) -> DataFrame:
    k = F.col("ord_id").cast("bigint")
    holes = t.retail_orders().withColumns(
        {
            "ord_date": F.when(k % 11 != 0, F.col("ord_date")),
            "location_id": F.when(k % 13 != 0, F.col("location_id")),
            "identity_ids": F.when(k % 17 != 0, F.col("identity_ids")),
        }
    )
    return sig.drop_null_keys(holes).select("ord_id")


@query("one_hot_metrics", _wide_sql(sig.CHANNEL_METRICS), METRIC_VIEWS)
def q_one_hot(t: Tables) -> DataFrame:
    signal = sig.channel_signal(F.col("ord_originate_channel_id"), F.col("ord_target_channel_id"))
    return sig.one_hot_metrics(t.retail_orders(), signal, sig.CHANNEL_METRICS).select("ord_id", *sig.metric_columns(sig.CHANNEL_METRICS))


def _metric_query(name: str, domain: str, build) -> None:
    @query(name, _wide_sql(domain), METRIC_VIEWS)
    def run(t: Tables) -> DataFrame:
        return build(t).select("ord_id", *sig.metric_columns(domain))


_metric_query("metric_orders", sig.ORDER_METRICS, lambda t: sig.metric_orders(t.retail_orders()))
_metric_query("metric_time_of_day", sig.TIME_METRICS, lambda t: sig.metric_time_of_day(local_orders(t)))
_metric_query("metric_hour_of_day", sig.HOUR_METRICS, lambda t: sig.metric_hour_of_day(local_orders(t)))
_metric_query("metric_channel", sig.CHANNEL_METRICS, lambda t: sig.metric_channel(t.retail_orders()))
_metric_query("metric_tender", sig.TENDER_METRICS, lambda t: sig.metric_tender(t.retail_orders(), t.tenders()))


def wide_signals(t: Tables) -> DataFrame:
    metrics = sig.with_all_metrics(local_orders(t), t.tenders())
    return sig.signals_grouping_sets(metrics, customer_identities(t.customer_360()))


@query(
    "signals_grouping_sets",
    "SELECT customer_360_id, partner_id, strftime(ord_date, '%Y-%m-%d') AS ord_date, location_id, "
    + ", ".join(
        f"CAST(coalesce(sum(signal_value) FILTER (signal_domain = '{d}' AND signal_name = '{s}'), 0) AS BIGINT) AS \"{sig.metric_column(d, s)}\""
        for d in (sig.ORDER_METRICS, sig.TENDER_METRICS, sig.TIME_METRICS) for s in sig.SIGNALS[d]
    )
    + " FROM daily GROUP BY ALL",
    METRIC_VIEWS,
)
def q_grouping_sets(t: Tables) -> DataFrame:
    domains = (sig.ORDER_METRICS, sig.TENDER_METRICS, sig.TIME_METRICS)
    metrics = sig.with_all_metrics(local_orders(t), t.tenders())
    return sig.signals_grouping_sets(metrics, customer_identities(t.customer_360()), *domains)


DAILY_SQL = "SELECT * EXCLUDE (ord_date, signal_value), strftime(ord_date, '%Y-%m-%d') AS ord_date, CAST(signal_value AS BIGINT) AS signal_value FROM daily"


@query("signals_unpivot", DAILY_SQL, METRIC_VIEWS)
def q_unpivot(t: Tables) -> DataFrame:
    return sig.signals_unpivot(wide_signals(t))


def daily_signals(t: Tables) -> DataFrame:
    return sig.preaggr_signals(t.retail_orders(), t.tenders(), t.locations(), t.customer_360())


@query(
    "preaggr_signals",
    """SELECT * EXCLUDE (ord_date, signal_value), strftime(ord_date, '%Y-%m-%d') AS ord_date,
              CAST(CASE WHEN year(ord_date) = 1998 THEN signal_value ELSE -signal_value END AS BIGINT) AS signal_value FROM daily""",
    METRIC_VIEWS,
)
def q_preaggr(t: Tables) -> DataFrame:
    """The days of 1998 changed: they are computed again and replace the stored ones."""
    dates = local_orders(t).select("ord_date").filter(F.year("ord_date") == 1998).distinct()
    stored = daily_signals(t).withColumn("signal_value", -F.col("signal_value"))
    fresh = sig.preaggr_signals(t.retail_orders(), t.tenders(), t.locations(), t.customer_360(), dates)
    return overwrite_where(stored, fresh, "ord_date", dates)


PERIOD_SQL = " UNION ALL ".join(
        f"""SELECT customer_360_id, partner_id, location_id, signal_domain, signal_name, '{p}' AS date_option, CAST(sum(signal_value) AS BIGINT) AS signal_value
            FROM daily WHERE ord_date BETWEEN DATE '{dt.date.fromisoformat(FEED) - dt.timedelta(days=n - 1)}' AND DATE '{FEED}'
            GROUP BY ALL"""
        for p, n in codes.PERIODS.items()
    )


@query("period_signals", PERIOD_SQL, METRIC_VIEWS)
def q_period(t: Tables) -> DataFrame:
    return sig.period_signals(daily_signals(t), FEED)


@query("period_signals_from_totals", PERIOD_SQL, METRIC_VIEWS)
def q_period_totals(t: Tables) -> DataFrame:
    """Totals of the edge days are stored, each one made from the one before it and the days between."""
    daily_path, path = scratch_folder(t.spark, "daily"), scratch_folder(t.spark, "totals")
    daily_signals(t).write.parquet(daily_path)  # in no order: a range sort would make the signals twice, to sample them, and shuffle them
    daily, before = t.spark.read.parquet(daily_path), None
    for day in sorted([*sig.edge_days(FEED).values(), FEED]):
        held = None if before is None else t.spark.read.parquet(f"{path}/as_of={before}")
        sig.extend_totals(held, daily, day, before).write.mode("append").partitionBy("as_of").parquet(path)
        before = day
    return sig.period_signals_from_totals(t.spark.read.parquet(path), FEED)


# ---- loyalty ------------------------------------------------------------------------

CONFIG = loy.LoyaltyConfig(new_days=60, loyal_days=90, at_risk_days=30, regular_days=120, rfm_threshold=0.4)


def _day(offset: int, base: str = FEED) -> str:
    return (dt.date.fromisoformat(base) + dt.timedelta(days=offset)).isoformat()


def scoped_view() -> str:
    return "SELECT * REPLACE (unnest([location_id, '_ALL']) AS location_id) FROM customer_orders"


def scaled(value: str, out: str) -> str:
    span = "OVER (PARTITION BY partner_id, location_id)"
    return f"coalesce(CAST({value} - min({value}) {span} AS DOUBLE) / nullif(max({value}) {span} - min({value}) {span}, 0), 1.0) AS {out}"


def loyalty_views(tag: str, end: str) -> dict[str, str]:
    """Scores and loyalty as of one date, built the plain way."""
    start = _day(1 - CONFIG.loyal_days, end)

    def block(i: int) -> str:
        lo, hi = _day(-30 * (i + 1) + 1, end), _day(-30 * i, end)
        return f"max(CASE WHEN ord_date BETWEEN DATE '{lo}' AND DATE '{hi}' THEN 1 ELSE 0 END)"

    return {
        f"act_{tag}": f"""
            SELECT customer_360_id, partner_id, location_id, date_diff('day', DATE '{start}', max(ord_date)) AS days_to_txn,
                   count(*) AS orders_n, CAST(sum(ord_pay_total) AS DOUBLE) AS amount, {block(0)} * {block(1)} * {block(2)} AS txn_all_months
            FROM scoped WHERE ord_date BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY ALL""",
        f"rfm_{tag}": f"""
            SELECT *, {scaled('days_to_txn', 'recency_score')}, {scaled('orders_n', 'frequency_score')}, {scaled('amount', 'monetary_score')} FROM act_{tag}""",
        f"score_{tag}": f"""
            SELECT *, {scaled('(recency_score + frequency_score + monetary_score)', 'rfm_score')} FROM rfm_{tag}""",
        f"loyal_{tag}": f"""
            SELECT customer_360_id, partner_id, location_id FROM score_{tag} WHERE rfm_score > {CONFIG.rfm_threshold} AND txn_all_months = 1""",
        f"new_{tag}": f"""
            SELECT customer_360_id, partner_id, location_id FROM scoped GROUP BY ALL
            HAVING min(ord_date) BETWEEN DATE '{_day(1 - CONFIG.new_days, end)}' AND DATE '{end}'""",
        f"active_{tag}": f"""
            SELECT DISTINCT customer_360_id, partner_id, location_id FROM scoped
            WHERE ord_date BETWEEN DATE '{_day(1 - CONFIG.regular_days, end)}' AND DATE '{end}'""",
    }


LOYALTY_VIEWS = {"scoped": scoped_view()}
for label, days_back in {"now": 0, **{f"p{n}": n for n in codes.PERIODS.values()}}.items():
    END = _day(-days_back)
    LOYALTY_VIEWS.update(loyalty_views(label, END))
    LOYALTY_VIEWS.update(loyalty_views(f"{label}_before", _day(1 - CONFIG.at_risk_days, END)))
    LOYALTY_VIEWS[f"risk_{label}"] = f"SELECT * FROM loyal_{label}_before EXCEPT SELECT * FROM loyal_{label}"
    LOYALTY_VIEWS[f"regular_{label}"] = (
        f"SELECT * FROM active_{label} EXCEPT (SELECT * FROM new_{label} UNION SELECT * FROM loyal_{label} UNION SELECT * FROM risk_{label})"
    )


def customer_orders(t: Tables) -> DataFrame:
    return loy.orders_by_customer(t.order_lines(), customer_identities(t.customer_360()))


def days(t: Tables) -> DataFrame:
    return loy.customer_days(loy.orders_by_customer(t.retail_orders(), customer_identities(t.customer_360())))


@query(
    "orders_by_customer",
    """SELECT customer_360_id, partner_id, location_id, ord_id, strftime(ord_date, '%Y-%m-%d') AS ord_date, CAST(ord_pay_total AS DOUBLE) AS ord_pay_total
       FROM customer_orders WHERE ord_id IN (SELECT ord_id FROM order_lines)""",
)
def q_orders_by_customer(t: Tables) -> DataFrame:
    return customer_orders(t)


def _score_query(name: str, column: str) -> None:
    @query(name, f"SELECT customer_360_id, partner_id, location_id, round({column}, 9) AS {column} FROM rfm_now", LOYALTY_VIEWS)
    def run(t: Tables) -> DataFrame:
        return loy.rfm_scores(days(t), [FEED], CONFIG.loyal_days).select(*loy.CUSTOMER, F.round(column, 9).alias(column))


_score_query("recency_score", "recency_score")
_score_query("frequency_score", "frequency_score")
_score_query("monetary_score", "monetary_score")


@query("loyal_indicator", "SELECT customer_360_id, partner_id, location_id, CAST(txn_all_months AS BIGINT) AS txn_all_months FROM act_now", LOYALTY_VIEWS)
def q_indicator(t: Tables) -> DataFrame:
    return loy.customer_activity(days(t), [FEED], CONFIG.loyal_days).select(*loy.CUSTOMER, "txn_all_months")


@query(
    "rfm_loyalty",
    f"""SELECT customer_360_id, partner_id, location_id, round(rfm_score, 9) AS rfm_score,
               rfm_score > {CONFIG.rfm_threshold} AND txn_all_months = 1 AS is_loyal FROM score_now""",
    LOYALTY_VIEWS,
)
def q_rfm(t: Tables) -> DataFrame:
    scored = loy.rfm_loyalty(days(t), [FEED], CONFIG.loyal_days, CONFIG.rfm_threshold)
    return scored.select(*loy.CUSTOMER, F.round("rfm_score", 9).alias("rfm_score"), "is_loyal")


@query("loyal_customers", "SELECT * FROM loyal_now", LOYALTY_VIEWS)
def q_loyal(t: Tables) -> DataFrame:
    return loy.loyal_customers(days(t), [FEED], CONFIG.loyal_days, CONFIG.rfm_threshold).drop("as_of")


@query("new_customers", "SELECT * FROM new_now", LOYALTY_VIEWS)
def q_new(t: Tables) -> DataFrame:
    return loy.new_customers(days(t), [FEED], CONFIG.new_days).drop("as_of")


def _typed(t: Tables, label: str) -> DataFrame:
    return loy.loyalty_at(days(t), [FEED], CONFIG).filter(F.col("loyalty_type") == label).select(*loy.CUSTOMER)


@query("at_risk_customers", "SELECT * FROM risk_now", LOYALTY_VIEWS)
def q_at_risk(t: Tables) -> DataFrame:
    return _typed(t, "AT_RISK")


@query("regular_customers", "SELECT * FROM regular_now", LOYALTY_VIEWS)
def q_regular(t: Tables) -> DataFrame:
    return _typed(t, "REGULAR")


LOYALTY_TYPES_SQL = " UNION ALL ".join(
    f"SELECT *, '{period}' AS date_option, '{label}' AS signal_value FROM {view}_p{n}"
    for period, n in codes.PERIODS.items()
    for label, view in (("NEW", "new"), ("LOYAL", "loyal"), ("AT_RISK", "risk"), ("REGULAR", "regular"))
)


@query("loyalty_types", LOYALTY_TYPES_SQL, LOYALTY_VIEWS)
def q_loyalty_types(t: Tables) -> DataFrame:
    orders = loy.orders_by_customer(t.retail_orders(), customer_identities(t.customer_360()))
    return loy.loyalty_types(orders, FEED, CONFIG)
