"""Queries of the signal catalogue, the profile documents, and the exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.operators import profile as prof
from tillwork.plans.bindings import AS_OF, Tables
from tillwork.plans.q_changes import scratch
from tillwork.plans.q_fields import cycle, cycle_sql, order_key
from tillwork.plans.q_signals import FEED, METRIC_VIEWS, daily_signals, sig
from tillwork.plans.registry import query
from tillwork.sources.document_sink import export_committed, read_export
from tillwork.sources.mapping import import_documents, map_columns, underscore_names
from tillwork.sources.sinks import export_documents, export_search_profile, replace_partitions, replace_within

PERIOD_NAMES = list(codes.PERIODS)


def signal_rows(t: Tables) -> DataFrame:
    """Partner-location signals derived from the orders, generated over ten days."""
    k = order_key()
    return t.read("orders").select(
        F.concat(F.lit("p"), k % 5).alias("partner_id"), F.concat(F.lit("loc"), k % 30).alias("location_id"),
        cycle(k, *PERIOD_NAMES).alias("date_option"), t.person(F.col("o_custkey")).alias("customer_360_id"),
        cycle(k, "loyalty", "visits", "gossip").alias("signal_domain"), cycle(F.floor(k / 3), "type", "count", "spend").alias("signal_name"),
        F.col("o_custkey").cast("string").alias("signal_value"),
        F.date_sub(F.lit(AS_OF).cast("date"), (F.floor(k / 2) % 10).cast("int")).alias("signal_generation_date"),
    )


def generic_rows(t: Tables) -> DataFrame:
    return signal_rows(t).drop("partner_id", "location_id", "date_option")


def catalogue(t: Tables) -> DataFrame:
    """Every signal the orders produce, but for the gossip domain and an inactive one; both types."""
    names = signal_rows(t).select(F.col("signal_domain").alias("domain_name"), "signal_name").distinct().filter("domain_name <> 'gossip'")
    kinds = F.explode(F.array(F.lit(prof.GENERAL), F.lit(prof.PARTNER_LOCATION)))
    return names.select("*", kinds.alias("signal_type")).select(
        "*", F.when(F.col("signal_name") == "type", "keyword").otherwise("integer").alias("es_type"),
        F.concat(F.lit("about_"), "domain_name").alias("section"),
        (~((F.col("domain_name") == "visits") & (F.col("signal_name") == "type"))).alias("is_active"),
    )


GENERATION = f"(DATE '{AS_OF}' - CAST((o_orderkey // 2) % 10 AS INTEGER))"
PROFILE_VIEWS = {
    "signal_rows": f"""
        SELECT 'p' || (o_orderkey % 5) AS partner_id, 'loc' || (o_orderkey % 30) AS location_id,
               {cycle_sql('o_orderkey', *[f"'{p}'" for p in PERIOD_NAMES])} AS date_option, 'cust' || (o_custkey // 30) AS customer_360_id,
               {cycle_sql('o_orderkey', "'loyalty'", "'visits'", "'gossip'")} AS signal_domain,
               {cycle_sql('(o_orderkey // 3)', "'type'", "'count'", "'spend'")} AS signal_name,
               CAST(o_custkey AS VARCHAR) AS signal_value, {GENERATION} AS signal_generation_date FROM orders""",
    "weekly": f"""
        SELECT * EXCLUDE (signal_generation_date, newest) FROM (
            SELECT *, max(signal_generation_date) OVER (PARTITION BY signal_domain, signal_name) AS newest
            FROM signal_rows WHERE signal_generation_date >= DATE '{AS_OF}' - 7) WHERE signal_generation_date = newest""",
    "daily_rows": f"SELECT * EXCLUDE (signal_generation_date) FROM signal_rows WHERE signal_generation_date = DATE '{AS_OF}'",
    "known": """
        SELECT signal_domain AS domain_name, 'about_' || signal_domain AS section, partner_id, location_id, date_option, customer_360_id, signal_value,
               signal_name || CASE signal_name WHEN 'type' THEN '_keyword' ELSE '_integer' END AS signal_es_name
        FROM {source} WHERE signal_domain <> 'gossip' AND NOT (signal_domain = 'visits' AND signal_name = 'type')""",
}
PROFILE_VIEWS["known_weekly"] = PROFILE_VIEWS["known"].format(source="weekly")
PROFILE_VIEWS["known_all"] = PROFILE_VIEWS["known"].format(source="signal_rows")
PROFILE_VIEWS["known_daily"] = PROFILE_VIEWS["known"].format(source="daily_rows")
PROFILE_VIEWS["known_both"] = "SELECT * FROM known_weekly UNION ALL SELECT * FROM known_daily"
del PROFILE_VIEWS["known"]


def weekly(t: Tables) -> DataFrame:
    return prof.latest_weekly_signals(signal_rows(t), AS_OF)


@query(
    "active_signal_catalogue",
    f"""SELECT DISTINCT signal_domain AS domain_name, signal_name, 'about_' || signal_domain AS section FROM signal_rows
        WHERE signal_domain <> 'gossip' AND NOT (signal_domain = 'visits' AND signal_name = 'type')""",
    PROFILE_VIEWS,
)
def q_catalogue(t: Tables) -> DataFrame:
    return prof.active_signal_catalogue(catalogue(t), prof.GENERAL).select("domain_name", "signal_name", "section")


@query("latest_weekly_signals", "SELECT * FROM weekly", PROFILE_VIEWS)
def q_weekly(t: Tables) -> DataFrame:
    return weekly(t)


@query("daily_signals", "SELECT * FROM daily_rows", PROFILE_VIEWS)
def q_daily(t: Tables) -> DataFrame:
    return prof.daily_signals(signal_rows(t), AS_OF)


@query("recognised_signals", "SELECT * FROM known_weekly", PROFILE_VIEWS)
def q_recognised(t: Tables) -> DataFrame:
    return prof.recognised_signals(weekly(t), prof.active_signal_catalogue(catalogue(t), prof.PARTNER_LOCATION))


PIVOT_KEY = ["customer_360_id", "section", "partner_id", "location_id", "date_option"]
DOMAINS = ["loyalty", "visits"]


def pivoted(t: Tables) -> DataFrame:
    rows = prof.recognised_signals(signal_rows(t).drop("signal_generation_date"), prof.active_signal_catalogue(catalogue(t), prof.PARTNER_LOCATION))
    return prof.domain_pivot(rows, PIVOT_KEY, DOMAINS)


def _text(pairs: Column, name: str, value: str) -> Column:
    return F.nullif(F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p[name], p[value])), ";"), F.lit(""))


def map_text(value: Column) -> Column:
    """'name=value;...' in order; null for an empty or missing map."""
    return _text(F.array_sort(F.map_entries(value)), "key", "value")


PIVOT_SQL = f"""SELECT {', '.join(PIVOT_KEY)}, string_agg({{v}}, ';' ORDER BY signal_es_name, signal_value) FILTER (domain_name = 'loyalty') AS loyalty,
    string_agg({{v}}, ';' ORDER BY signal_es_name, signal_value) FILTER (domain_name = 'visits') AS visits FROM ({{src}}) GROUP BY ALL"""
FIRST_VALUE = "SELECT domain_name, section, partner_id, location_id, date_option, customer_360_id, signal_es_name, min(signal_value) AS signal_value FROM {src} GROUP BY ALL"


@query("domain_pivot", PIVOT_SQL.format(v="signal_es_name || '=' || signal_value", src="SELECT DISTINCT * FROM known_all"), PROFILE_VIEWS)
def q_pivot(t: Tables) -> DataFrame:
    return pivoted(t).select(*PIVOT_KEY, *[_text(F.col(d), "signal_es_name", "signal_value").alias(d) for d in DOMAINS])


@query("lists_to_maps", PIVOT_SQL.format(v="signal_es_name || '=' || signal_value", src=FIRST_VALUE.format(src="known_all")), PROFILE_VIEWS)
def q_maps(t: Tables) -> DataFrame:
    return prof.lists_to_maps(pivoted(t), DOMAINS).select(*PIVOT_KEY, *[map_text(F.col(d)).alias(d) for d in DOMAINS])


def nested_text(domains: Column) -> Column:
    """'domain[name=value;...]' of a domain -> name -> value map."""
    entries = F.array_sort(
        F.transform(F.map_entries(domains), lambda e: F.concat(e["key"], F.lit("["), map_text(e["value"]), F.lit("]")))
    )
    return F.nullif(F.array_join(entries, ","), F.lit(""))


def generic(t: Tables) -> DataFrame:
    return prof.generic_profile(prof.daily_signals(generic_rows(t), AS_OF), catalogue(t))


GENERIC_SQL = """
    SELECT customer_360_id, max(CASE WHEN domain_name = 'loyalty' THEN txt END) AS about_loyalty, max(CASE WHEN domain_name = 'visits' THEN txt END) AS about_visits
    FROM (SELECT customer_360_id, domain_name, domain_name || '[' || string_agg(signal_es_name || '=' || v, ';' ORDER BY signal_es_name) || ']' AS txt
          FROM (SELECT customer_360_id, domain_name, signal_es_name, min(signal_value) AS v FROM known_daily GROUP BY ALL) GROUP BY customer_360_id, domain_name) GROUP BY customer_360_id"""


@query("generic_profile", GENERIC_SQL, PROFILE_VIEWS)
def q_generic(t: Tables) -> DataFrame:
    return generic(t).select("customer_360_id", *[nested_text(F.col(s)).alias(s) for s in ("about_loyalty", "about_visits")])


def partner_location(t: Tables) -> DataFrame:
    both = weekly(t).unionByName(prof.daily_signals(signal_rows(t), AS_OF, prof.SIGNAL_COLUMNS))
    return prof.partner_location_profile(both, catalogue(t), t.locations())


def entries_text(entries: Column) -> Column:
    def one(e: Column) -> Column:
        periods = [F.concat(F.lit(f"{p}:"), F.coalesce(nested_text(e[p]), F.lit("-"))) for p in PERIOD_NAMES]
        return F.concat_ws("/", e["partner_id_keyword"], e["location_id_keyword"], e["location_name_keyword"], *periods)

    return F.nullif(F.array_join(F.array_sort(F.transform(entries, one)), " "), F.lit(""))


PLACES_VIEW = {
    **PROFILE_VIEWS,
    "period_texts": f"""
        SELECT customer_360_id, domain_name, partner_id, location_id, date_option,
               domain_name || '[' || string_agg(signal_es_name || '=' || signal_value, ';' ORDER BY signal_es_name) || ']' AS txt
        FROM ({FIRST_VALUE.format(src='known_both')}) GROUP BY customer_360_id, domain_name, partner_id, location_id, date_option""",
    "place_texts": "SELECT p.customer_360_id, p.domain_name, p.partner_id || '/' || p.location_id || '/' || coalesce(any_value(l.location_nm), p.location_id)"
    + "".join(f" || '/{p}:' || coalesce(max(txt) FILTER (date_option = '{p}'), '-')" for p in PERIOD_NAMES)
    + " AS txt FROM period_texts p LEFT JOIN locations l ON l.partner_id = p.partner_id AND l.location_id = p.location_id GROUP BY p.customer_360_id, p.domain_name, p.partner_id, p.location_id",
    "place_profile": """SELECT customer_360_id, string_agg(txt, ' ' ORDER BY txt) FILTER (domain_name = 'loyalty') AS about_loyalty,
                               string_agg(txt, ' ' ORDER BY txt) FILTER (domain_name = 'visits') AS about_visits FROM place_texts GROUP BY ALL""",
}


@query("partner_location_profile", "SELECT * FROM place_profile", PLACES_VIEW)
def q_places(t: Tables) -> DataFrame:
    return partner_location(t).select("customer_360_id", *[entries_text(F.col(s)).alias(s) for s in ("about_loyalty", "about_visits")])


def profiles(t: Tables) -> DataFrame:
    stores = partner_location(t).withColumnsRenamed({"about_loyalty": "store_loyalty", "about_visits": "store_visits"})
    return prof.customer_profile(t.customer_360(), generic(t), stores)


CUSTOMER_PROFILE_SQL = f"""
    SELECT c.customer_360_id, g.about_loyalty, g.about_visits, p.about_loyalty AS store_loyalty, p.about_visits AS store_visits
    FROM customers c LEFT JOIN ({GENERIC_SQL}) g USING (customer_360_id) LEFT JOIN place_profile p USING (customer_360_id) WHERE c.active_flag"""


def profile_texts(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_360_id", *[nested_text(F.col(s)).alias(s) for s in ("about_loyalty", "about_visits")],
        *[entries_text(F.col(s)).alias(s) for s in ("store_loyalty", "store_visits")],
    )


@query("customer_profile", CUSTOMER_PROFILE_SQL, PLACES_VIEW)
def q_profile(t: Tables) -> DataFrame:
    return profile_texts(profiles(t))


# ---- exports and imports ------------------------------------------------------------


@query("export_search_profile", CUSTOMER_PROFILE_SQL, PLACES_VIEW)
def q_export_search(t: Tables) -> DataFrame:
    """Written as keyed documents, read back and parsed again."""
    path, whole = scratch(t, "search"), profiles(t)
    export_search_profile(whole, path)
    read = t.spark.read.parquet(path)
    parsed = read.select("key", F.from_json("document", whole.schema).alias("d")).filter("key = d.customer_360_id")
    return profile_texts(parsed.select("d.*"))


@query("export_documents", "SELECT ord_id, partner_id AS partner, CAST(ord_pay_total AS DOUBLE) AS total FROM retail_orders")
def q_export(t: Tables) -> DataFrame:
    path = scratch(t, "documents")
    mapping = [{"source": "ord_id", "dest": "_id"}, {"source": "partner_id", "dest": "partner"}, {"source": "ord_pay_total", "dest": "total", "cast": "double"}]
    export_documents(t.retail_orders(), path, ["_id"], mapping, include_all=False)
    read = t.spark.read.schema("_id STRING, partner STRING, total DOUBLE").json(path)
    return read.withColumnRenamed("_id", "ord_id")


@query("export_documents_committed", "SELECT ord_id, partner_id AS partner, CAST(ord_pay_total AS DOUBLE) AS total FROM retail_orders")
def q_export_committed(t: Tables) -> DataFrame:
    """Two exports, one for the even and one for the odd totals in cents, the first of them run twice."""
    path = scratch(t, "committed")
    mapping = [{"source": "ord_id", "dest": "_id"}, {"source": "partner_id", "dest": "partner"}, {"source": "ord_pay_total", "dest": "total", "cast": "double"}]
    orders = t.retail_orders()
    even = F.coalesce(F.pmod(F.round(F.col("ord_pay_total") * 100).cast("bigint"), F.lit(2)) == 0, F.lit(False))
    for name, part in [("even", even), ("odd", ~even), ("even", even)]:
        export_committed(orders.filter(part), path, ["_id"], name, mapping, include_all=False)
    return read_export(t.spark, path, "_id STRING, partner STRING, total DOUBLE").withColumnRenamed("_id", "ord_id")


@query(
    "map_columns",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS full_name, TRY_CAST(c_name AS BIGINT) AS bad_number, c_mktsegment FROM customer",
)
def q_map(t: Tables) -> DataFrame:
    spaced = t.read("customer").select(F.col("c_custkey").alias("cust key"), F.col("c_name"), F.col("c_name").alias("copy"), "c_mktsegment")
    mapping = [{"source": "cust_key", "dest": "id", "cast": "string"}, {"source": "c_name", "dest": "full_name"}, {"source": "copy", "dest": "bad_number", "cast": "bigint"}]
    return map_columns(underscore_names(spaced), mapping, include_all=True)


@query(
    "import_documents",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'old' END AS name,
              CASE WHEN c_custkey % 2 = 0 THEN '2024-01-01' ELSE '2023-01-01' END AS feed_date FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0""",
)
def q_import(t: Tables) -> DataFrame:
    """Documents of the even keys, each twice, onto a table of every third key."""
    k = F.col("c_custkey")
    stored = t.read("customer").filter(k % 3 == 0).select(k.alias("id"), F.lit("old").alias("name"), F.lit("2023-01-01").cast("date").alias("feed_date"))
    even = t.read("customer").filter(k % 2 == 0).select(k.cast("string").alias("_id"), F.col("c_name").alias("title"), "c_acctbal")
    mapping = [{"source": "_id", "dest": "id", "cast": "bigint"}, {"source": "title", "dest": "name"}]
    return import_documents(stored, even.unionByName(even), mapping, False, "2024-01-01", ["id"])


PERIOD_WRITE_SQL = " UNION ALL ".join(
    f"""SELECT customer_360_id, partner_id, location_id, signal_domain, signal_name, '{p}' AS date_option, CAST(sum(signal_value) AS BIGINT) AS signal_value,
               '{FEED}' AS signal_generation_date
        FROM daily WHERE ord_date BETWEEN DATE '{dt.date.fromisoformat(FEED) - dt.timedelta(days=n - 1)}' AND DATE '{FEED}' GROUP BY ALL"""
    for p, n in codes.PERIODS.items()
)


@query("period_signals_write", PERIOD_WRITE_SQL, METRIC_VIEWS)
def q_period_write(t: Tables) -> DataFrame:
    """Stale values and a signal that is gone are written first, then the whole day is replaced."""
    found = sig.period_signals(daily_signals(t), FEED).withColumn("signal_generation_date", F.lit(FEED).cast("date"))
    path, by, kept = scratch(t, "periods"), ["signal_generation_date", "signal_domain", "signal_name"], scratch(t, "found")
    found.write.parquet(kept)  # computed once for all writes
    rows = t.spark.read.parquet(kept)
    stale = rows.withColumn("signal_value", F.lit(-1).cast("bigint"))
    replace_partitions(stale.unionByName(stale.withColumn("signal_name", F.lit("gone"))), path, by)
    replace_within(rows, path, by, t.spark.range(1).select(F.lit(FEED).cast("date").alias("signal_generation_date")))
    return t.spark.read.parquet(path)
