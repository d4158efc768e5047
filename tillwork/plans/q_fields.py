"""Queries of the field normalisation and of the pseudonymisation jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes, fields
from tillwork.operators import privacy
from tillwork.plans.bindings import FEED_DATE, SALT, ZONES, Tables
from tillwork.plans.registry import query


def order_key() -> Column:
    return F.col("o_orderkey")


def cust_key() -> Column:
    return F.col("c_custkey")



def cycle(key: Column, *values) -> Column:
    """The value at key modulo the number of values."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v).cast("string") for v in values]), (key % len(values)).cast("int"))


def cycle_sql(key: str, *values: str) -> str:
    return f"([{', '.join(values)}])[{key} % {len(values)} + 1]"


# ---- codes --------------------------------------------------------------------------


@query(
    "conform_codes_text",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '2', '1', '99', '0', '0', '3', '99')}::BIGINT AS tender,
               {cycle_sql('o_orderkey', '2', '4', '1', '3', '99', '0')}::BIGINT AS state FROM orders""",
)
def q_codes_text(t: Tables) -> DataFrame:
    tender = cycle(order_key(), " card ", "Cash", "no_sale", "", None, "SQUARE_GIFT_CARD", "barter")
    state = cycle(order_key(), "draft", " COMPLETED", "open", "Cancelled", "lost", "  ")
    return t.read("orders").select(
        order_key().alias("ord_id"),
        codes.conform_text(tender, codes.SQUARE_TENDER).alias("tender"),
        codes.conform_text(state, codes.SQUARE_STATE).alias("state"),
    )


@query(
    "conform_codes_int",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '0', '1', '2', '3', '3', '99', '4', '99', '2', '99', '0')}::BIGINT AS tender FROM orders""",
)
def q_codes_int(t: Tables) -> DataFrame:
    return t.read("orders").select(
        order_key().alias("ord_id"),
        codes.conform_int(cycle(order_key(), *[str(i) for i in range(10)], None), codes.PARBRINK_TENDER).alias("tender"),
    )


SOURCES = ["Popmenu pickup", "Square Online store", "Doordash", "Ubereats 1", "Register", None]
TYPES = ["Dine In", "Eat In", "Carry Out", "Delivery", "Order Ahead", "Other", None]


def fulfillments() -> Column:
    def one(state, kind):
        return F.struct(F.lit(state).alias("state"), F.lit(kind).cast("string").alias("type"))

    # by key modulo 4: none, a completed pickup after a proposed shipment, no type, shipment first
    lists = F.array(
        F.array(),
        F.array(one("PROPOSED", "SHIPMENT"), one("COMPLETED", "PICKUP")),
        F.array(one("COMPLETED", None)),
        F.array(one("PROPOSED", "SHIPMENT"), one("PROPOSED", "PICKUP")),
    )
    return F.get(lists, (order_key() % 4).cast("int"))


SQUARE_CHANNEL_SQL = f"""
    SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '5', '5', '6', '6', '1', '1')}::BIGINT AS originate,
           CASE WHEN o_orderkey % 6 <= 3 THEN 4 WHEN o_orderkey % 4 = 1 THEN 3 ELSE 0 END::BIGINT AS target FROM orders"""


@query("channel_rules_square", SQUARE_CHANNEL_SQL)
def q_channel_square(t: Tables) -> DataFrame:
    name = cycle(order_key(), *SOURCES)
    return t.read("orders").select(
        order_key().alias("ord_id"), codes.square_originate(name).alias("originate"), codes.square_target(name, fulfillments()).alias("target")
    )


@query(
    "channel_rules_toast",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '1', '3', '99', '99', '0')}::BIGINT AS originate,
               {cycle_sql('o_orderkey', '1', '3', '4', '99', '0')}::BIGINT AS target FROM orders""",
)
def q_channel_toast(t: Tables) -> DataFrame:
    behaviour = cycle(order_key(), "dine_in", "TAKE_OUT", "Delivery", "catering", None)
    return t.read("orders").select(
        order_key().alias("ord_id"),
        codes.toast_channel(behaviour, codes.TOAST_ORIGINATE).alias("originate"),
        codes.toast_channel(behaviour, codes.TOAST_TARGET).alias("target"),
    )


@query(
    "channel_rules_omnivore",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '1', '1', '1', '99', '99', '0', '0')}::BIGINT AS originate,
               {cycle_sql('o_orderkey', '1', '1', '3', '4', '1', '0', '0')}::BIGINT AS target FROM orders""",
)
def q_channel_omnivore(t: Tables) -> DataFrame:
    name = cycle(order_key(), *TYPES)
    return t.read("orders").select(
        order_key().alias("ord_id"), codes.omnivore_originate(name).alias("originate"), codes.omnivore_target(name).alias("target")
    )


@query(
    "channel_rules_parbrink",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '1', '0', '6', '5', '1', '99', '0', '0')}::BIGINT AS originate,
               {cycle_sql('o_orderkey', '1', '3', '4', '3', '3', '99', '0', '0')}::BIGINT AS target FROM orders""",
)
def q_channel_parbrink(t: Tables) -> DataFrame:
    name = cycle(order_key(), "For Here", "take-out", "Uber Eats 2", "Curbside!", "Drive Thru", "Boat", "42", None)
    return t.read("orders").select(
        order_key().alias("ord_id"),
        codes.parbrink_channel(name, codes.PARBRINK_ORIGINATE).alias("originate"),
        codes.parbrink_channel(name, codes.PARBRINK_TARGET).alias("target"),
    )


@query(
    "conform_channel",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '5', '5', '6', '6', '1', '1')}::BIGINT AS from_source,
               CASE WHEN o_orderkey % 6 <= 3 THEN 4 WHEN o_orderkey % 4 = 1 THEN 3 ELSE 0 END::BIGINT AS from_source_and_fulfilment,
               {cycle_sql('o_orderkey', '1', '1', '3', '4', '1', '0', '0')}::BIGINT AS from_order_type FROM orders""",
)
def q_conform_channel(t: Tables) -> DataFrame:
    """One channel code from one source column, from two, and by another profile's rule."""
    return t.read("orders").select(
        order_key().alias("ord_id"),
        codes.square_originate(cycle(order_key(), *SOURCES)).alias("from_source"),
        codes.square_target(cycle(order_key(), *SOURCES), fulfillments()).alias("from_source_and_fulfilment"),
        codes.omnivore_target(cycle(order_key(), *TYPES)).alias("from_order_type"),
    )


@query(
    "state_rules",
    f"""SELECT o_orderkey AS ord_id, {cycle_sql('o_orderkey', '3', '1', '3', '4', '0')}::BIGINT AS by_flags,
               {cycle_sql('o_orderkey', '4', '1', '4', '0', '0')}::BIGINT AS by_closed FROM orders""",
)
def q_state_rules(t: Tables) -> DataFrame:
    return t.read("orders").select(
        order_key().alias("ord_id"),
        codes.omnivore_state(cycle(order_key(), "true", "true", "false", "false", None), cycle(order_key(), "true", "false", "true", "false", "true")).alias("by_flags"),
        codes.closed_flag_state(cycle(order_key(), "true", "false", "TRUE", "maybe", None)).alias("by_closed"),
    )


# ---- places, money, dates -----------------------------------------------------------


@query(
    "conform_zip",
    f"""SELECT c_custkey, {cycle_sql('c_custkey', "lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')", "lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')",
        'NULL', 'NULL', 'NULL')} AS zip FROM customer""",
)
def q_zip(t: Tables) -> DataFrame:
    five = F.lpad((cust_key() % 100000).cast("string"), 5, "0")
    text = cycle(cust_key(), five, F.concat(five, F.lit("-1234")), F.concat(five, F.lit("1")), F.concat(F.lit("A"), five), F.concat(five, F.lit("-12")))
    return t.read("customer").select("c_custkey", fields.zip_code(text).alias("zip"))


@query(
    "clean_city_text",
    f"""SELECT c_custkey, {cycle_sql('c_custkey', "c_mktsegment || ' city'", "c_mktsegment || 'city'", "c_mktsegment || 'city'", "c_mktsegment || 'city'")} AS city FROM customer""",
)
def q_city(t: Tables) -> DataFrame:
    parts = [F.lit(" city"), F.lit("\tcity"), F.lit("\\ncity"), F.lit("\x07city\n")]
    text = cycle(cust_key(), *[F.concat("c_mktsegment", p) for p in parts])
    return t.read("customer").select("c_custkey", fields.city_text(text).alias("city"))


@query(
    "cents_to_money",
    """SELECT o_orderkey AS ord_id, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS DOUBLE) / 100 WHEN 1 THEN CAST(o_orderkey AS DOUBLE) / 100 END AS money FROM orders""",
)
def q_money(t: Tables) -> DataFrame:
    text = cycle(order_key(), order_key().cast("string"), F.concat(F.lit(" "), order_key(), F.lit(" ")), "12a", " ")
    return t.read("orders").select(order_key().alias("ord_id"), fields.cents_to_money(text).alias("money"))


@query(
    "parse_dates",
    """SELECT o_orderkey AS ord_id, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso,
              CASE o_orderkey % 4 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS patterned FROM orders""",
)
def q_dates(t: Tables) -> DataFrame:
    text = cycle(
        order_key(), F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "dd/MM/yyyy"), "2021-02-30", None
    )
    return t.read("orders").select(
        order_key().alias("ord_id"), fields.to_date_or_null(text).alias("iso"), fields.to_date_or_null(text, "dd/MM/yyyy").alias("patterned")
    )


@query(
    "parse_timestamps",
    """SELECT o_orderkey AS ord_id, strftime(ord_timestamp + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS with_offset,
              strftime(ord_timestamp + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS zone_wins,
              strftime(ord_timestamp, '%Y-%m-%d %H:%M:%S') AS from_epoch,
              strftime(ord_timestamp + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS patterned, CAST(NULL AS VARCHAR) AS bad
       FROM retail_orders""",
)
def q_timestamps(t: Tables) -> DataFrame:
    local = F.date_format("ord_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    offset_text = F.concat(local, F.lit("-05:00"))
    return t.retail_orders().select(
        F.col("ord_id").cast("bigint").alias("ord_id"),
        fields.iso_timestamp(offset_text).alias("with_offset"),
        fields.iso_timestamp(offset_text, "America/Phoenix").alias("zone_wins"),
        fields.epoch_timestamp(F.unix_seconds("ord_timestamp").cast("string")).alias("from_epoch"),
        fields.pattern_timestamp(F.date_format("ord_timestamp", "yyyyMMdd HHmmss"), "yyyyMMdd HHmmss", "America/Phoenix").alias("patterned"),
        fields.iso_timestamp(F.concat(F.lit("x"), "ord_id")).alias("bad"),
    )


@query(
    "to_local_time",
    """SELECT o_orderkey AS ord_id, strftime((ord_timestamp AT TIME ZONE 'UTC') AT TIME ZONE
                  coalesce(([NULL, 'America/New_York', 'America/Chicago', 'America/Denver', 'America/Los_Angeles'])[o_orderkey % 5 + 1], 'UTC'),
                  '%Y-%m-%d %H:%M:%S') AS local_timestamp FROM retail_orders""",
)
def q_local_time(t: Tables) -> DataFrame:
    key = F.col("ord_id").cast("bigint")
    return t.retail_orders().select(key.alias("ord_id"), fields.local_time(F.col("ord_timestamp"), cycle(key, None, *ZONES)).alias("local_timestamp"))


def _zone_rows() -> str:
    return ", ".join(f"({code}, '{name}')" for code, name in codes.TIMEZONE.items())


@query(
    "conform_timezone",
    f"SELECT c_custkey, z.name AS timezone FROM customer LEFT JOIN (VALUES {_zone_rows()}) z(code, name) ON c_custkey % 150 = z.code",
)
def q_timezone(t: Tables) -> DataFrame:
    return t.read("customer").select("c_custkey", codes.lookup((cust_key() % 150).cast("int"), codes.TIMEZONE).alias("timezone"))


@query(
    "year_week_to_date",
    """SELECT o_orderkey AS ord_id,
              strftime(first_day + CAST((6 - dayofweek(first_day)) % 7 AS INTEGER) + CAST(7 * (o_orderkey % 52 + 1) - 1 AS INTEGER), '%Y-%m-%d') AS week_end
       FROM (SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS first_day FROM orders)""",
)
def q_year_week(t: Tables) -> DataFrame:
    text = F.concat(F.year("o_orderdate"), F.lit("-"), F.lpad((order_key() % 52 + 1).cast("string"), 2, "0"))
    return t.read("orders").select(order_key().alias("ord_id"), fields.year_week_to_date(text).alias("week_end"))


# ---- privacy ------------------------------------------------------------------------


def contacts(t: Tables) -> DataFrame:
    """Customers with contacts as people type them; some are blank or broken."""
    user = F.concat(F.lit("user"), cust_key())
    digits = F.concat(F.lit("212"), (F.lit(4560000) + cust_key() % 10000).cast("string"))
    dashed = F.concat_ws("-", digits.substr(1, 3), digits.substr(4, 3), digits.substr(7, 4))
    return t.read("customer").select(
        "c_custkey",
        cycle(cust_key(), F.concat(user, F.lit("@Mail.COM")), F.concat(F.lit(" "), user, F.lit("@mail.com ")), F.concat(user, F.lit("@host")), "@mail.com", " ").alias("email"),
        cycle(cust_key(), digits, dashed, F.concat(F.lit("+1 "), dashed), F.concat(F.lit("+"), dashed), "123456789", F.concat(F.lit("1ABC"), digits)).alias("phone"),
        cycle(cust_key(), F.concat(F.lit(" ab-"), cust_key()), "").alias("maid"),
    )


CONTACT_VIEWS = {
    "contacts_clean": """
        SELECT c_custkey, CASE WHEN c_custkey % 5 <= 1 THEN 'user' || c_custkey || '@mail.com' END AS email,
               CASE WHEN c_custkey % 6 <= 2 THEN '1212' || (4560000 + c_custkey % 10000) END AS phone,
               CASE WHEN c_custkey % 2 = 0 THEN 'AB-' || c_custkey END AS maid FROM customer""",
    "lookup_rows": f"""
        SELECT original_value, sha256(original_value || '{SALT}') AS hashed_value, identity_type
        FROM (SELECT email AS original_value, 'email' AS identity_type, c_custkey FROM contacts_clean UNION ALL SELECT phone, 'phone', c_custkey FROM contacts_clean
              UNION ALL SELECT maid, 'MAID-UNKNOWN', c_custkey FROM contacts_clean) WHERE original_value IS NOT NULL""",
}
RULES = [
    privacy.Rule("email", codes.EMAIL, "email"),
    privacy.Rule("phone", codes.PHONE, "phone"),
    privacy.Rule("maid", codes.MAID_UNKNOWN, "advertiser_id"),
]


@query("normalise_contact", "SELECT * FROM contacts_clean", CONTACT_VIEWS)
def q_contact(t: Tables) -> DataFrame:
    return contacts(t).select(
        "c_custkey", fields.email(F.col("email")).alias("email"), fields.phone(F.col("phone")).alias("phone"), fields.advertiser_id(F.col("maid")).alias("maid")
    )


@query(
    "pseudonymise_columns",
    f"""SELECT 'table' AS part, CAST(c_custkey AS VARCHAR) AS k, sha256(email || '{SALT}') AS a, sha256(phone || '{SALT}') AS b, sha256(maid || '{SALT}') AS c FROM contacts_clean
        UNION ALL SELECT 'lookup', identity_type, original_value, hashed_value, NULL FROM lookup_rows""",
    CONTACT_VIEWS,
)
def q_pseudonymise(t: Tables) -> DataFrame:
    hashed, lookup = privacy.pseudonymise_columns(contacts(t), RULES, SALT)
    table = hashed.select(F.lit("table").alias("part"), cust_key().cast("string").alias("k"), F.col("email").alias("a"), F.col("phone").alias("b"), F.col("maid").alias("c"))
    return table.union(lookup.select(F.lit("lookup"), "identity_type", "original_value", "hashed_value", F.lit(None).cast("string")))


JSON_SCHEMA = "id STRING, rate STRING, contact STRUCT<email: STRING, note: STRING>, others ARRAY<STRUCT<phone: STRING, kind: STRING>>"
JSON_RULES = [
    privacy.Rule("doc", codes.EMAIL, "email", ("contact", "email")),
    privacy.Rule("doc", codes.PHONE, "phone", ("others", "*", "phone")),
]
JSON_SQL = f"""
    SELECT 'doc' AS part, CAST(c_custkey AS VARCHAR) AS k, sha256(email || '{SALT}') AS a, sha256(phone || '{SALT}') AS b FROM contacts_clean
    UNION ALL SELECT 'lookup', identity_type, original_value, hashed_value FROM lookup_rows WHERE identity_type <> 'MAID-UNKNOWN'
    UNION ALL SELECT 'rest', CAST(c_custkey AS VARCHAR), '1.' || c_custkey || '0', 'say "' || c_custkey || '" é' FROM customer
    UNION ALL SELECT 'whole', CAST(c_custkey AS VARCHAR), '{{"id":"' || c_custkey || '", "none":null,"rate":1.' || c_custkey || '0,"rate2":12345678901234567890.12,"contact":{{"email":'
        || coalesce('"' || sha256(email || '{SALT}') || '"', 'null') || ',"note":"say \\"' || c_custkey || '\\" é"}},"others":[{{"phone":'
        || coalesce('"' || sha256(phone || '{SALT}') || '"', 'null') || ',"kind":"home"}},{{"kind":"none"}}]}}', NULL FROM contacts_clean"""


def contact_documents(t: Tables) -> DataFrame:
    """Documents with fields that no rule names: exact numbers, a null, escapes, blanks."""
    key = cust_key().cast("string")
    text = F.concat(
        F.lit('{"id":"'), key, F.lit('", "none":null,"rate":1.'), key, F.lit('0,"rate2":12345678901234567890.12,"contact":{"email":"'), F.col("email"),
        F.lit('","note":"say \\"'), key, F.lit('\\" é"},"others":[{"phone":"'), F.col("phone"), F.lit('","kind":"home"},{"kind":"none"}]}'),
    )
    return contacts(t).select("c_custkey", text.alias("doc"))


def _json_result(hashed: DataFrame, lookup: DataFrame) -> DataFrame:
    key, none = cust_key().cast("string"), F.lit(None).cast("string")
    values = [
        ("doc", F.col("d.contact.email"), F.get(F.col("d.others.phone"), F.lit(0))),
        ("rest", F.regexp_extract("doc", '"rate":([0-9.]+)', 1), F.col("d.contact.note")),
        ("whole", F.col("doc"), none),
    ]
    parts = F.array(*[F.struct(F.lit(part).alias("part"), key.alias("k"), a.alias("a"), b.alias("b")) for part, a, b in values])
    docs = hashed.select("c_custkey", "doc", F.from_json("doc", JSON_SCHEMA).alias("d")).select(F.inline(parts))
    return docs.union(lookup.select(F.lit("lookup"), "identity_type", "original_value", "hashed_value"))


@query("pseudonymise_json", JSON_SQL, CONTACT_VIEWS)
def q_pseudonymise_json(t: Tables) -> DataFrame:
    return _json_result(*privacy.pseudonymise_json(contact_documents(t), JSON_RULES, SALT))


JSON_TEXT_SQL = f"""
    SELECT 'doc' AS part, CAST(c_custkey AS VARCHAR) AS k, sha256(email || '{SALT}') AS a, sha256(phone || '{SALT}') AS b FROM contacts_clean
    UNION ALL SELECT 'lookup', identity_type, original_value, hashed_value FROM lookup_rows WHERE identity_type <> 'MAID-UNKNOWN'"""


@query("pseudonymise_json_text", JSON_TEXT_SQL, CONTACT_VIEWS)
def q_pseudonymise_json_text(t: Tables) -> DataFrame:
    """Documents written from rows, which leave out what is null."""
    doc = F.struct(cust_key().cast("string").alias("id"), F.struct("email").alias("contact"), F.array(F.struct("phone", F.lit("home").alias("kind"))).alias("others"))
    documents = contacts(t).select("c_custkey", F.to_json(doc).alias("doc"))
    return _json_result(*privacy.pseudonymise_json(documents, JSON_RULES, SALT)).filter("part IN ('doc', 'lookup')")


LOOKUP_COLUMNS = ["original_value", "hashed_value", "identity_type", "feed_date", "run_id", "source_id"]


def stamped_lookup(t: Tables, run: str, feed_date: str = FEED_DATE) -> DataFrame:
    _, lookup = privacy.pseudonymise_columns(contacts(t), RULES, SALT)
    return lookup.select(
        "*", F.lit(feed_date).cast("date").alias("feed_date"), F.lit(run).alias("run_id"), F.lit("p1").alias("source_id")
    )


@query(
    "privacy_lookup_upsert",
    f"""SELECT DISTINCT * FROM (
        SELECT CASE WHEN identity_type = 'email' THEN original_value ELSE 'stale' END AS original_value, hashed_value, identity_type,
               '{FEED_DATE}' AS feed_date, 'run1' AS run_id, 'p1' AS source_id FROM lookup_rows WHERE identity_type IN ('email', 'phone')
        UNION ALL SELECT original_value, hashed_value, identity_type, '2023-12-31', 'run0', 'p1' FROM lookup_rows WHERE identity_type = 'email')""",
    CONTACT_VIEWS,
)
def q_lookup_upsert(t: Tables) -> DataFrame:
    _, lookup = privacy.pseudonymise_columns(contacts(t), RULES, SALT)
    emails = F.col("identity_type") == "email"
    earlier = stamped_lookup(t, "run0", "2023-12-31").filter(emails)
    stale = stamped_lookup(t, "run1").filter("identity_type IN ('email', 'phone')").withColumn("original_value", F.lit("stale"))
    table = earlier.unionByName(stale).distinct()
    return privacy.privacy_lookup_upsert(table.select(*LOOKUP_COLUMNS), lookup.filter(emails), "p1", FEED_DATE, "run1")


@query(
    "privacy_lookup_dedup",
    f"""SELECT DISTINCT 'p1' AS source_id, identity_type, hashed_value,
               CASE WHEN identity_type = 'phone' THEN 'kept' ELSE original_value END AS original_value,
               CASE WHEN identity_type = 'phone' THEN '2023-12-31' ELSE '{FEED_DATE}' END AS feed_date FROM lookup_rows""",
    CONTACT_VIEWS,
)
def q_lookup_dedup(t: Tables) -> DataFrame:
    """Phones are known already; run2 is not among the changed pairs."""
    columns = ["source_id", "identity_type", "hashed_value", "original_value", "feed_date"]
    final = (
        stamped_lookup(t, "run0", "2023-12-31").filter("identity_type = 'phone'")
        .withColumn("original_value", F.lit("kept")).select(*columns).distinct()
    )
    runs = t.read("region").filter("r_regionkey < 2").select(
        F.concat(F.lit("run"), F.col("r_regionkey") + 1).alias("run_id"), F.date_add(F.lit(FEED_DATE).cast("date"), F.col("r_regionkey").cast("int")).alias("feed_date")
    )
    stamped = stamped_lookup(t, "run1").withColumn("both", F.explode(F.array(F.lit("run1"), F.lit("run2")))).drop("run_id", "feed_date")
    intermediate = stamped.join(runs, F.col("both") == F.col("run_id")).drop("both")
    return privacy.privacy_lookup_dedup(final, intermediate, runs.filter("run_id = 'run1'"))


@query(
    "identity_metadata",
    """SELECT DISTINCT hashed_value AS identity_id, identity_type AS type, CAST(3 AS BIGINT) AS weight,
              CASE WHEN identity_type = 'phone' THEN original_value[1:4] END AS phone_area_code,
              CASE WHEN identity_type = 'email' THEN split_part(original_value, '@', 2) END AS email_domain FROM lookup_rows""",
    CONTACT_VIEWS,
)
def q_metadata(t: Tables) -> DataFrame:
    _, lookup = privacy.pseudonymise_columns(contacts(t), RULES, SALT)
    identities = lookup.select(F.col("hashed_value").alias("identity_id"), F.col("identity_type").alias("type"), F.lit(3).alias("weight"))
    return privacy.with_identity_metadata(identities, lookup).select(
        "identity_id", "type", "weight",
        F.element_at("metadata", F.lit("phone_area_code")).alias("phone_area_code"),
        F.element_at("metadata", F.lit("email_domain")).alias("email_domain"),
    )
