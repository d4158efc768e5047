"""Queries of the vendor feeds and the demographic signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.operators import demographics as dem
from tillwork.operators import feeds
from tillwork.operators import insights as ins
from tillwork.operators.keyed import merge_upsert
from tillwork.plans.bindings import FEED_DATE, Tables
from tillwork.plans.q_changes import scratch
from tillwork.plans.q_fields import cust_key, cycle, cycle_sql, order_key
from tillwork.plans.registry import query
from tillwork.sources.sinks import replace_partitions, replace_within

# ---- market feed --------------------------------------------------------------------


def market_raw(t: Tables) -> DataFrame:
    """One payload line per order; some without state, postal code or type, some of another kind."""
    k, cust = order_key(), F.col("o_custkey")

    def quoted(value):
        return F.concat(F.lit('"'), value, F.lit('"'))

    payload = F.concat_ws(
        "|",
        quoted(F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.lpad((k % 52 + 1).cast("string"), 2, "0"))),
        quoted(F.concat(F.lit("Merchant "), (cust % 40).cast("string"))),
        quoted(F.lit("FOOD AND DINING")),
        F.when(k % 23 == 0, "").otherwise(quoted(F.concat(F.lit("type "), (k % 6).cast("string")))),
        quoted(F.when(k % 19 == 0, "").otherwise("AZ")),
        quoted(F.when(k % 17 == 0, "").otherwise((k % 27 + 10000).cast("string"))),
        F.lit("10"),
        (k % 90 + 1).cast("string"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
        F.lit("1.5"),
    )
    return t.read("orders").select(
        F.when(k % 29 == 0, "merch").otherwise(feeds.MARKET_RECORD).alias("record_type"), payload.alias("record_value"),
        F.when(k % 2 == 0, FEED_DATE).otherwise("2023-12-31").alias("feed_date"),
    )


def postal_codes(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t.read("nation").select(
        (n + 10000).cast("string").alias("postal_code"),
        F.when(n != 24, F.concat(F.lit("city "), F.lower("n_name"))).alias("city"),
        F.when(n != 23, F.concat(F.lit("region "), F.col("n_regionkey"))).alias("region"),
        F.lower("n_name").alias("state_code"),
        (n + 30).cast("string").alias("lat"), (-n - 70).cast("string").alias("lng"),
    )


def merchants(t: Tables) -> DataFrame:
    k = cust_key()
    return t.read("customer").select(
        F.concat(F.lit("Merchant "), k % 40).alias("merchant"), F.concat(F.lit("TYPE "), k % 6).alias("location_type"),
        F.when(k % 40 % 3 == 0, "Other").otherwise(F.concat(F.lit("industry "), k % 4)).alias("industry_category"),
        F.when(k % 40 % 5 == 0, "Other").otherwise(F.concat(F.lit("cuisine "), k % 4)).alias("cuisine_category"),
    ).filter(k % 8 != 0).distinct()


def location_types(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t.read("nation").filter(n < 4).select(
        F.concat(F.lit("TYPE "), n).alias("location_type"), F.concat(F.lit("type industry "), n).alias("industry_category"),
        F.when(n != 2, F.concat(F.lit("type cuisine "), n)).alias("cuisine_category"),
    )


MARKET_VIEWS = {
    "parsed": """
        SELECT *, strftime(first_day + CAST((6 - dayofweek(first_day)) % 7 AS INTEGER) + CAST(7 * (o_orderkey % 52 + 1) - 1 AS INTEGER), '%Y-%m-%d') AS date,
               'Merchant ' || (o_custkey % 40) AS merchant, 'type ' || (o_orderkey % 6) AS location_type, 'AZ' AS state,
               CAST(o_orderkey % 27 + 10000 AS VARCHAR) AS postal_code, o_orderkey % 90 + 1 AS transaction_quantity, o_totalprice AS transaction_amount
        FROM (SELECT *, make_date(year(o_orderdate), 1, 1) AS first_day FROM orders)
        WHERE o_orderkey % 29 <> 0 AND o_orderkey % 23 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 17 <> 0""",
    "postal_codes": """
        SELECT CAST(n_nationkey + 10000 AS VARCHAR) AS postal_code, CASE WHEN n_nationkey <> 24 THEN 'city ' || lower(n_name) END AS city,
               CASE WHEN n_nationkey <> 23 THEN 'region ' || n_regionkey END AS region, lower(n_name) AS state_code,
               CAST(n_nationkey + 30 AS VARCHAR) AS lat, CAST(-n_nationkey - 70 AS VARCHAR) AS lng FROM nation""",
    "enriched": """
        SELECT date, merchant, upper(location_type) AS location_type, state, p.postal_code, transaction_quantity, transaction_amount,
               'City ' || upper(state_code[1]) || state_code[2:] AS city, coalesce(region, 'Unknown') AS region
        FROM (SELECT *, row_number() OVER (PARTITION BY date, merchant, postal_code ORDER BY location_type, state, transaction_quantity, transaction_amount) AS rn FROM parsed) f
        JOIN postal_codes p ON p.postal_code = f.postal_code WHERE rn = 1 AND city IS NOT NULL""",
    "merchants": """
        SELECT DISTINCT 'Merchant ' || (c_custkey % 40) AS merchant, 'TYPE ' || (c_custkey % 6) AS location_type,
               CASE WHEN c_custkey % 40 % 3 <> 0 THEN 'industry ' || (c_custkey % 4) END AS mi, CASE WHEN c_custkey % 40 % 5 <> 0 THEN 'cuisine ' || (c_custkey % 4) END AS mc
        FROM customer WHERE c_custkey % 8 <> 0""",
    "location_types": """
        SELECT 'TYPE ' || n_nationkey AS location_type, 'type industry ' || n_nationkey AS ti,
               CASE WHEN n_nationkey <> 2 THEN 'type cuisine ' || n_nationkey END AS tc FROM nation WHERE n_nationkey < 4""",
    "categorised": """
        SELECT date, merchant, location_type, coalesce(mi, ti, 'Other') AS industry_category, coalesce(mc, tc, 'Other') AS cuisine_category,
               state, postal_code, transaction_quantity, transaction_amount, city, region
        FROM enriched LEFT JOIN merchants USING (merchant, location_type) LEFT JOIN location_types USING (location_type)""",
}
FEED_COLUMNS = "date, merchant, location_type, state, postal_code, CAST(transaction_quantity AS BIGINT) AS transaction_quantity, transaction_amount"


@query("market_feed_parse", f"SELECT {FEED_COLUMNS} FROM parsed WHERE o_orderkey % 2 = 0", MARKET_VIEWS)
def q_parse(t: Tables) -> DataFrame:
    return feeds.market_feed_parse(market_raw(t), FEED_DATE)


def enriched(t: Tables) -> DataFrame:
    return feeds.market_feed_enrich(feeds.market_feed_parse(market_raw(t)), postal_codes(t))


@query("market_feed_enrich", "SELECT * FROM enriched", MARKET_VIEWS)
def q_enrich(t: Tables) -> DataFrame:
    return enriched(t)


def categorised(t: Tables) -> DataFrame:
    return feeds.market_feed_categorise(enriched(t), merchants(t), location_types(t))


@query("market_feed_categorise", "SELECT * FROM categorised", MARKET_VIEWS)
def q_categorise(t: Tables) -> DataFrame:
    return categorised(t)


@query(
    "market_feed_merge",
    """SELECT date, merchant, postal_code, CASE WHEN date >= '1998' THEN transaction_amount ELSE 0 END AS transaction_amount FROM categorised
       WHERE date >= '1998' OR date < '1997'""",
    MARKET_VIEWS,
)
def q_market_merge(t: Tables) -> DataFrame:
    """Stored: the years before 1997 and 1998, with zero amounts; fresh: 1998 and later."""
    rows = categorised(t).select("date", "merchant", "postal_code", "transaction_amount")
    stored = rows.filter("date < '1997' OR date LIKE '1998%'").withColumn("transaction_amount", F.lit(0.0))
    return feeds.market_feed_merge(stored, rows.filter("date >= '1998'"))


@query(
    "total_market_from_feed",
    """SELECT cuisine_category AS location_type, region, state, city, date, round(sum(transaction_amount), 2) AS transaction_amount,
              CAST(sum(transaction_quantity) AS BIGINT) AS transaction_quantity FROM categorised GROUP BY ALL HAVING NOT (date < '1997' AND sum(transaction_quantity) > 20)""",
    MARKET_VIEWS,
)
def q_total_from_feed(t: Tables) -> DataFrame:
    """Rows before 1997 of more than 20 transactions are published already."""
    feed = categorised(t).withColumn("transaction_amount", F.col("transaction_amount").cast("decimal(14,2)"))
    sums = ins.total_market_from_feed(feed, feed, full=True)
    published = sums.filter("date < '1997' AND transaction_quantity > 20")
    return ins.total_market_from_feed(feed, published)


# ---- persons ------------------------------------------------------------------------


def person_raw(t: Tables) -> DataFrame:
    """Two rows per customer key; four keys share a person, some values are missing."""
    k = cust_key()
    rows = t.read("customer").select(
        F.concat(F.lit("tid"), F.floor(k / 4).cast("string")).alias("person_id"), F.concat(F.lit("hh"), k % 9).alias("household_id"),
        F.when(k % 7 != 0, F.sha2(F.concat(F.lit("mail"), F.floor(k / 2).cast("string")), 256)).alias("sha256_lower_email"),
        F.when(k % 5 != 0, F.concat(F.lit("maid"), k)).alias("native_maid"),
        F.when(k % 3 == 0, "2023-12-31").otherwise(FEED_DATE).alias("feed_date"),
    )
    return rows.unionByName(rows)


def _person_sql(value: str, where: str, out: str) -> str:
    return f"""SELECT 'tid' || (c_custkey // 4) AS person_id, max('hh' || (c_custkey % 9)) AS household_id,
                      array_to_string(list_sort(list(DISTINCT {value})), '|') AS {out}
               FROM customer WHERE c_custkey % 3 <> 0 AND {where} GROUP BY 1"""


def _half_stored(fresh: DataFrame) -> DataFrame:
    """A stored table that knows the persons whose id ends in an even digit."""
    return fresh.filter(F.col("person_id").rlike("[02468]$")).withColumn("household_id", F.lit("stale"))


@query("person_emails", _person_sql("sha256('mail' || (c_custkey // 2))", "c_custkey % 7 <> 0", "sha256_lower_emails"))
def q_person_emails(t: Tables) -> DataFrame:
    fresh = feeds.person_emails(person_raw(t), FEED_DATE)
    return merge_upsert(_half_stored(fresh), fresh, ["person_id"])


@query("person_devices", _person_sql("'maid' || c_custkey", "c_custkey % 5 <> 0", "native_maids"))
def q_person_devices(t: Tables) -> DataFrame:
    fresh = feeds.person_devices(person_raw(t), FEED_DATE)
    return merge_upsert(_half_stored(fresh), fresh, ["person_id"])


def geo_raw(t: Tables) -> DataFrame:
    k = cust_key()
    five = (k % 30 + 10000).cast("string")
    return t.read("customer").select(
        F.concat(F.lit("tid"), k).alias("person_id"), F.concat(F.lit("hh"), k % 9).alias("household_id"),
        cycle(k, five, F.concat(five, F.lit("-0001")), F.concat(F.lit("x"), five), None).alias("zip"), F.lit(FEED_DATE).alias("feed_date"),
        F.lit("f").alias("file_name"), F.lit("s").alias("source_id"),
    )


PERSON_GEO_SQL = """SELECT 'tid' || c_custkey AS person_id, 'hh' || (c_custkey % 9) AS household_id,
    CASE WHEN c_custkey % 4 <= 1 THEN CAST(c_custkey % 30 + 10000 AS VARCHAR) END AS zip_code FROM customer WHERE c_custkey % 4 <> 3"""


@query("person_geo", PERSON_GEO_SQL)
def q_person_geo(t: Tables) -> DataFrame:
    fresh = feeds.person_geo(geo_raw(t), FEED_DATE)
    return merge_upsert(_half_stored(fresh), fresh, ["person_id"])


# ---- attributes ---------------------------------------------------------------------


def attributes_raw(t: Tables) -> DataFrame:
    k = cust_key()
    return t.read("customer").select(
        F.concat(F.lit("tid"), k).alias("person_id"),
        F.substring("c_mktsegment", 1, 1).alias("occupation"),
        F.concat(F.lit("N"), "c_nationkey").alias("income"),
        cycle(k, "Y", "no", "U", None, "1", "F").alias("home_owner"),
        (k % 80 + 18).cast("string").alias("age"),
    )


def dictionary(t: Tables, nations: int = 25) -> DataFrame:
    jobs = t.read("customer").select(
        F.lit("occupation").alias("code_category"), F.substring("c_mktsegment", 1, 1).alias("code"), F.lower("c_mktsegment").alias("code_value")
    )
    incomes = t.read("nation").filter(F.col("n_nationkey") < nations).select(
        F.lit("income"), F.concat(F.lit("N"), "n_nationkey"), F.concat(F.col("n_nationkey") * 10, F.lit("k"))
    )
    return jobs.distinct().union(incomes)


RULES = {"keep": ["person_id"], "boolean": ["home_owner"], "integer": ["age"], "categories": ["occupation", "income"]}
ATTRIBUTE_SQL = f"""SELECT 'tid' || c_custkey AS person_id, lower(c_mktsegment) AS occupation, (c_nationkey * 10) || 'k' AS income,
    {cycle_sql('c_custkey', 'true', 'false', 'NULL', 'NULL', 'true', 'false')} AS home_owner, CAST(c_custkey % 80 + 18 AS BIGINT) AS age FROM customer"""


def attributes(t: Tables) -> DataFrame:
    return feeds.person_attributes_decode(attributes_raw(t), dictionary(t), **RULES)


@query("person_attributes_decode", ATTRIBUTE_SQL)
def q_decode(t: Tables) -> DataFrame:
    raw = attributes_raw(t)
    feeds.require_no_rejects(feeds.validate_codes(raw, dictionary(t), ["occupation", "income"]))
    return attributes(t)


@query(
    "validate_codes",
    """SELECT 'income' AS code_category, 'N' || c_nationkey AS code, count(*) AS cells FROM customer WHERE c_nationkey >= 20 GROUP BY ALL
       UNION ALL SELECT 'card', 'C' || c_custkey % 997, count(*) FROM customer WHERE c_custkey % 997 % 2 = 1 GROUP BY ALL""",
)
def q_validate(t: Tables) -> DataFrame:
    """The dictionary lacks the last nations and every odd card code."""
    card = F.concat(F.lit("C"), F.substring("person_id", 4, 20).cast("bigint") % 997)
    cards = t.spark.range(0, 997, 2).select(F.lit("card"), F.concat(F.lit("C"), "id"), F.lit("a card"))
    return feeds.validate_codes(attributes_raw(t).withColumn("card", card), dictionary(t, nations=20).union(cards), ["occupation", "income", "card"])


@query(
    "person_attributes_merge",
    "SELECT 'tid' || c_custkey AS person_id, CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 80 + 18 ELSE 0 END AS BIGINT) AS age FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0",
)
def q_attributes_merge(t: Tables) -> DataFrame:
    rows = attributes(t).select("person_id", "age", F.substring("person_id", 4, 20).cast("bigint").alias("k"))
    stored = rows.filter("k % 2 = 0").withColumn("age", F.lit(0))
    return feeds.person_attributes_merge(stored, rows.filter("k % 3 = 0")).drop("k")


# ---- demographic signals ------------------------------------------------------------


def customers_with_persons(t: Tables) -> DataFrame:
    k = cust_key()
    persons = t.read("customer").groupBy(t.person(k).alias("customer_360_id")).agg(
        F.array_sort(F.collect_set(F.concat(F.lit("tid"), k))).alias("persons")
    )
    return t.customer_360().join(persons, "customer_360_id").withColumn(
        "identities", F.map_concat("identities", F.create_map(F.lit(codes.PERSON_ID), F.col("persons")))
    ).drop("persons")


DEMO_VIEWS = {
    **MARKET_VIEWS,
    "persons": """SELECT 'cust' || (c_custkey // 30) AS customer_360_id, 'tid' || c_custkey AS person_id FROM customer WHERE c_custkey // 30 % 10 <> 9""",
    "attributes": ATTRIBUTE_SQL,
    "geos": PERSON_GEO_SQL,
    "cells": """SELECT person_id, 'occupation' AS signal_name, occupation AS v FROM attributes UNION ALL SELECT person_id, 'income', income FROM attributes
                UNION ALL SELECT person_id, 'home_owner', CAST(home_owner AS VARCHAR) FROM attributes UNION ALL SELECT person_id, 'age', CAST(age AS VARCHAR) FROM attributes""",
    "places": """SELECT person_id, 'zip_code' AS signal_name, zip_code AS v FROM geos
                 UNION ALL SELECT person_id, 'location', lat || ',' || lng FROM geos JOIN postal_codes ON postal_code = zip_code""",
}


def signal_sql(source: str) -> str:
    return f"""SELECT customer_360_id, '{FEED_DATE}' AS signal_generation_date, 'profile' AS signal_domain, signal_name, min(v) AS signal_value
               FROM persons JOIN {source} USING (person_id) WHERE v IS NOT NULL GROUP BY ALL"""


@query("customers_with_person_id", "SELECT * FROM persons", DEMO_VIEWS)
def q_persons(t: Tables) -> DataFrame:
    return dem.customers_with_person_id(customers_with_persons(t))


def demographic(t: Tables) -> DataFrame:
    return dem.demographic_signals(dem.customers_with_person_id(customers_with_persons(t)), attributes(t), FEED_DATE)


def geographic(t: Tables) -> DataFrame:
    geo = feeds.person_geo(geo_raw(t), FEED_DATE)
    return dem.geographic_signals(dem.customers_with_person_id(customers_with_persons(t)), geo, postal_codes(t), FEED_DATE)


@query("demographic_signals", signal_sql("cells"), DEMO_VIEWS)
def q_demographic(t: Tables) -> DataFrame:
    return demographic(t)


@query("geographic_signals", signal_sql("places"), DEMO_VIEWS)
def q_geographic(t: Tables) -> DataFrame:
    return geographic(t)


@query("signal_partition_write", f"{signal_sql('cells')} UNION ALL {signal_sql('places')}", DEMO_VIEWS)
def q_signal_write(t: Tables) -> DataFrame:
    """Stale values and a signal that is gone are written first, then the day and domain are replaced."""
    path, by = scratch(t, "signals"), ["signal_generation_date", "signal_domain", "signal_name"]
    rows = demographic(t).unionByName(geographic(t))
    stale = rows.withColumn("signal_value", F.lit("stale"))
    gone = rows.filter("signal_name = 'age'").withColumn("signal_name", F.lit("shoe_size"))
    replace_partitions(stale.unionByName(gone), path, by)
    replace_within(rows, path, by, rows.select(*by[:2]).distinct())
    return t.spark.read.parquet(path)
