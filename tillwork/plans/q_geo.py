"""Queries of the device-location operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import geo
from tillwork.operators.keyed import merge_partial_update, overwrite_where
from tillwork.plans.bindings import Tables
from tillwork.plans.registry import query
from tillwork.session import joins_as_dealt, scratch_folder, stored_once
from tillwork.sources.ping_store import PingStore

ACCURACY_MAX, DISTANCE, MULTIPLIER = 50.0, 600.0, 1.0
BOX, GAPS = 500.0, 5
INTERVAL = 12 * 3600
TODAY, LOOKBACK = "2000-10-20", 15
MIN_FREQUENCY, CUTOFF = 1, 0.2

R = "6378137.0::DOUBLE"
GEO_VIEWS = {
    "stores_m": f"""SELECT partner_id, location_id, {R} * radians(long) AS x_m, {R} * ln(tan(pi() / 4 + radians(lat) / 2)) AS y_m
                    FROM locations WHERE active_flg = '1'""",
    "pings_m": f"""SELECT *, {R} * radians(longitude) AS x, {R} * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y,
                          horizontal_accuracy * {MULTIPLIER} + {DISTANCE} AS max_distance,
                          TIMESTAMP '1970-01-01' + to_seconds(utc_seconds) AS geo_timestamp FROM device_pings""",
    "overlap": f"""SELECT partner_id, location_id, maid, maid_type, latitude, longitude, horizontal_accuracy, geo_timestamp,
                          CAST(geo_timestamp AS DATE) AS geo_date, sqrt((x - x_m) ** 2 + (y - y_m) ** 2) AS distance_to_store, max_distance
                   FROM pings_m JOIN stores_m ON sqrt((x - x_m) ** 2 + (y - y_m) ** 2) <= max_distance WHERE horizontal_accuracy <= {ACCURACY_MAX}""",
    "geo_orders": f"""SELECT DISTINCT r.partner_id, r.location_id, r.ord_id, r.ord_date, g.maid, g.maid_type
                      FROM overlap g JOIN retail_orders r ON r.partner_id = g.partner_id AND r.location_id = g.location_id
                       AND g.geo_timestamp BETWEEN r.ord_timestamp - to_seconds({INTERVAL}) AND r.ord_timestamp + to_seconds({INTERVAL})""",
    "scored": "SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY ord_id, partner_id) AS device_score FROM geo_orders",
    "links": """SELECT maid, maid_type, customer_360_id, count(*) AS frequency_linked, sum(device_score) AS link_score
                FROM scored JOIN order_customers USING (ord_id) GROUP BY ALL""",
    "totals": """SELECT *, count(*) OVER d AS total_profiles_per_maid, sum(link_score) OVER d AS total_score_per_maid,
                        count(*) OVER c AS total_maids_per_profile, sum(link_score) OVER c AS total_score_per_profile
                 FROM links WINDOW d AS (PARTITION BY maid_type, maid), c AS (PARTITION BY customer_360_id)""",
    "confident": f"""SELECT *, CASE WHEN frequency_linked >= {MIN_FREQUENCY} THEN 1.0::DOUBLE ELSE 0 END * (frequency_linked / total_score_per_profile)
                            * (link_score / total_score_per_profile) * pow(link_score / total_score_per_maid, 0.1) AS confidence_score FROM totals""",
}
OVERLAP_SQL = """SELECT partner_id, location_id, maid, maid_type, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, horizontal_accuracy,
    strftime(geo_timestamp, '%Y-%m-%d %H:%M:%S') AS geo_timestamp, strftime(geo_date, '%Y-%m-%d') AS geo_date,
    round({distance}, 3) AS distance_to_store, max_distance AS max_distance_to_store FROM overlap"""


def stores(t: Tables) -> DataFrame:
    return geo.geo_project(t.locations())


def overlap(t: Tables) -> DataFrame:
    return geo.geo_overlap(t.device_pings(), stores(t), ACCURACY_MAX, DISTANCE, MULTIPLIER)


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6), "distance_to_store": F.round("distance_to_store", 3)})


@query("geo_project", "SELECT partner_id, location_id, round(x_m, 3) AS x_m, round(y_m, 3) AS y_m FROM stores_m", GEO_VIEWS)
def q_project(t: Tables) -> DataFrame:
    return stores(t).withColumns({"x_m": F.round("x_m", 3), "y_m": F.round("y_m", 3)})


def gap_sql(axis: str, metres: str, degrees: str) -> str:
    """Pings in one of the widest gaps of an axis, from the sorted boxes."""
    return f"""SELECT {degrees.format('hi')} AS lo, {degrees.format('next_lo')} AS hi FROM (
        SELECT max({metres} + {BOX}) OVER (ORDER BY {metres}) AS hi, lead({metres} - {BOX}) OVER (ORDER BY {metres}) AS next_lo FROM stores_m)
        WHERE next_lo > hi ORDER BY {degrees.format('next_lo')} - {degrees.format('hi')} DESC, lo LIMIT {GAPS}"""


LAT = f"degrees(2 * atan(exp(({{}}) / {R})) - pi() / 2)"
LON = f"degrees(({{}}) / {R})"


@query(
    "geo_prefilter",
    f"""SELECT maid, utc_seconds, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM device_pings p
        WHERE latitude BETWEEN (SELECT {LAT.format(f'min(y_m) - {BOX}')} FROM stores_m) AND (SELECT {LAT.format(f'max(y_m) + {BOX}')} FROM stores_m)
          AND longitude BETWEEN (SELECT {LON.format(f'min(x_m) - {BOX}')} FROM stores_m) AND (SELECT {LON.format(f'max(x_m) + {BOX}')} FROM stores_m)
          AND NOT EXISTS (SELECT 1 FROM ({gap_sql('latitude', 'y_m', LAT)}) g WHERE p.latitude > g.lo AND p.latitude < g.hi)
          AND NOT EXISTS (SELECT 1 FROM ({gap_sql('longitude', 'x_m', LON)}) g WHERE p.longitude > g.lo AND p.longitude < g.hi)""",
    GEO_VIEWS,
)
def q_prefilter(t: Tables) -> DataFrame:
    kept = t.device_pings().filter(geo.geo_prefilter(stores(t), BOX, GAPS))
    return kept.select(
        F.coalesce("advertiser_id_AAID", "advertiser_id_IDFA").alias("maid"), F.col("utc_timestamp").cast("bigint").alias("utc_seconds"),
        F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
    )


@query("geo_overlap", OVERLAP_SQL.format(distance="distance_to_store"), GEO_VIEWS)
def q_overlap(t: Tables) -> DataFrame:
    return rounded(overlap(t))


@query("geo_overlap_stored", OVERLAP_SQL.format(distance="distance_to_store"), GEO_VIEWS)
def q_overlap_stored(t: Tables) -> DataFrame:
    """The same from pings stored by area."""
    kept = PingStore(scratch_folder(t.spark, "pings"))
    kept.write(t.device_pings())
    return rounded(kept.overlap(stores(t), ACCURACY_MAX, DISTANCE, MULTIPLIER))


@query(
    "geo_overlap_merge",
    OVERLAP_SQL.format(distance="CASE WHEN month(geo_timestamp) = 9 THEN 0 ELSE distance_to_store END"),
    GEO_VIEWS,
)
def q_overlap_merge(t: Tables) -> DataFrame:
    """September was stored with a distance of zero, half of October is new."""
    rows = overlap(t)
    stored = rows.filter((F.month("geo_date") == 9) | (F.dayofmonth("geo_date") <= 10)).withColumn("distance_to_store", F.lit(0.0))
    fresh = rows.filter(F.month("geo_date") != 9)
    changed = ["latitude", "longitude", "horizontal_accuracy", "distance_to_store", "max_distance_to_store"]
    return rounded(merge_partial_update(stored, fresh, geo.GEO_KEY, changed))


@query(
    "geo_dates_to_reprocess",
    """WITH od AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 50 = 0),
            gd AS (SELECT DISTINCT CAST(ts AS DATE) - 8500 AS d FROM events WHERE event_id % 3 = 0),
            fo AS (SELECT d FROM od UNION SELECT d + CAST(i AS INTEGER) FROM gd, (SELECT unnest([-1, 0, 1]) AS i))
       SELECT 'order' AS kind, strftime(d, '%Y-%m-%d') AS day FROM fo
       UNION SELECT 'geo', strftime(d + CAST(i AS INTEGER), '%Y-%m-%d') FROM fo, (SELECT unnest([-1, 0, 1]) AS i)""",
)
def q_dates(t: Tables) -> DataFrame:
    changed_orders = t.read("orders").filter("o_orderkey % 50 = 0").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    changed_pings = t.read("events").filter("event_id % 3 = 0").select(F.date_sub(F.col("ts").cast("date"), 8500).alias("d")).distinct()
    orders, pings = geo.geo_dates_to_reprocess(changed_orders, changed_pings)
    return orders.select(F.lit("order").alias("kind"), F.col("ord_date").alias("day")).union(pings.select(F.lit("geo"), "geo_date"))


def geo_orders(t: Tables) -> DataFrame:
    return geo.geo_order_interval_join(t.retail_orders(), overlap(t), INTERVAL)


ORDER_COLUMNS = ["partner_id", "location_id", "ord_id", "ord_date", "maid", "maid_type"]


@query("geo_order_interval_join", "SELECT * REPLACE (strftime(ord_date, '%Y-%m-%d') AS ord_date) FROM geo_orders", GEO_VIEWS)
def q_interval(t: Tables) -> DataFrame:
    return geo_orders(t).select(*ORDER_COLUMNS)


@query("geo_device_score", "SELECT * REPLACE (strftime(ord_date, '%Y-%m-%d') AS ord_date, round(device_score, 9) AS device_score) FROM scored", GEO_VIEWS)
def q_score(t: Tables) -> DataFrame:
    counted = geo.geo_order_interval_join(t.retail_orders(), overlap(t), INTERVAL, count_devices=True)
    return geo.geo_device_score(counted).select(*ORDER_COLUMNS, F.round("device_score", 9).alias("device_score"))


@query(
    "replace_dates",
    """SELECT * REPLACE (strftime(ord_date, '%Y-%m-%d') AS ord_date), CASE WHEN day(ord_date) % 2 = 0 THEN 'new' ELSE 'old' END AS tag FROM geo_orders""",
    GEO_VIEWS,
)
def q_replace(t: Tables) -> DataFrame:
    """Even days are recomputed and replaced, the others stay. The days are those of the orders: finding them takes no pairs."""
    rows = geo_orders(t).select(*ORDER_COLUMNS)
    even = t.retail_orders().select("ord_date").filter(F.dayofmonth("ord_date") % 2 == 0).distinct()
    return overwrite_where(rows.withColumn("tag", F.lit("old")), rows.withColumn("tag", F.lit("new")), "ord_date", even)


@query(
    "lookback_filter",
    f"SELECT * REPLACE (strftime(ord_date, '%Y-%m-%d') AS ord_date) FROM geo_orders WHERE ord_date >= DATE '{TODAY}' - {LOOKBACK - 1}",
    GEO_VIEWS,
)
def q_lookback(t: Tables) -> DataFrame:
    return geo.lookback_filter(geo_orders(t), TODAY, LOOKBACK).select(*ORDER_COLUMNS)


def kept(df: DataFrame) -> DataFrame:
    return stored_once(df, "geo")


def links(t: Tables) -> DataFrame:
    """An order's customers are looked up and its devices counted once per order, not once per order and device.

    What grows with the input is stored where several steps read it; what grows with pairs is neither stored nor shuffled before it is counted.
    """
    joins_as_dealt(t.spark)  # by blocks of devices
    pings, customers = overlap(t), t.customer_360()
    orders = geo.with_order_customers(kept(geo.orders_near(t.retail_orders(), pings, INTERVAL, kept)), customers)
    pairs = geo.geo_order_interval_join(orders, pings, INTERVAL, carry=("customer_360_ids",), count_devices=True, keep=kept)
    return geo.geo_customer_link(geo.geo_device_score(pairs), customers)


@query(
    "geo_customer_link",
    "SELECT maid, maid_type, customer_360_id, frequency_linked, round(link_score, 9) AS profile_maid_link_score FROM links",
    GEO_VIEWS,
)
def q_link(t: Tables) -> DataFrame:
    return links(t).withColumn("profile_maid_link_score", F.round("profile_maid_link_score", 9))


def confident(t: Tables) -> DataFrame:
    """The links are made once and stored: their totals read them again, and being few are stored too, so that the links need no shuffle to meet them."""
    return geo.geo_confidence(stored_once(links(t), "links"), MIN_FREQUENCY, keep=lambda totals: stored_once(totals, "totals"))


@query(
    "geo_confidence",
    """SELECT maid, maid_type, customer_360_id, frequency_linked, round(link_score, 9) AS profile_maid_link_score, total_profiles_per_maid,
              round(total_score_per_maid, 9) AS total_score_per_maid, total_maids_per_profile, round(total_score_per_profile, 9) AS total_score_per_profile,
              round(confidence_score, 9) AS confidence_score FROM confident""",
    GEO_VIEWS,
)
def q_confidence(t: Tables) -> DataFrame:
    scores = ["profile_maid_link_score", "total_score_per_maid", "total_score_per_profile", "confidence_score"]
    return confident(t).withColumns({c: F.round(c, 9) for c in scores})


@query("geo_identities", f"SELECT DISTINCT maid AS identity_id, maid_type AS type FROM confident WHERE confidence_score > {CUTOFF}", GEO_VIEWS)
def q_identities(t: Tables) -> DataFrame:
    return geo.geo_identities(geo.above_cutoff(confident(t), CUTOFF)).select("identity_id", "type")


@query(
    "geo_edges",
    f"""SELECT maid AS source, maid_type AS source_type, identity_id AS target, identity_type AS target_type, 'geoRelated' AS relationship,
               frequency_linked AS frequency, '{TODAY}' AS created_date, '{TODAY}' AS last_seen_date, true AS active_flag
        FROM confident JOIN active_identities USING (customer_360_id) WHERE confidence_score > {CUTOFF}""",
    GEO_VIEWS,
)
def q_geo_edges(t: Tables) -> DataFrame:
    """The customers are stored first: there are far fewer of them than links."""
    return geo.geo_edges(geo.above_cutoff(confident(t), CUTOFF), stored_once(t.customer_360(), "customers"), TODAY)
