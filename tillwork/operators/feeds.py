"""Vendor reference feeds: market sums, person contacts, coded person attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import fields
from tillwork.operators.keyed import first_per_key, merge_upsert

# ---- market feed --------------------------------------------------------------------

MARKET_RECORD = "zip_merch"
MARKET_SCHEMA = (
    "date STRING, merchant STRING, category STRING, location_type STRING, state STRING, postal_code STRING, "
    "distinct_customers INT, transaction_quantity INT, transaction_amount DOUBLE, transaction_amount_avg DOUBLE"
)
MARKET_KEY = ["date", "merchant", "postal_code"]


def market_feed_parse(raw: DataFrame, feed_date: str | None = None) -> DataFrame:
    """Pipe-separated payloads as typed rows, of one feed date or of all."""
    rows = raw.filter(F.col("record_type") == MARKET_RECORD)
    if feed_date is not None:
        rows = rows.filter(F.col("feed_date") == feed_date)
    return rows.select(F.from_csv("record_value", MARKET_SCHEMA, {"sep": "|"}).alias("r")).select(
        F.date_format(fields.year_week_to_date(F.col("r.date")), "yyyy-MM-dd").alias("date"),
        "r.merchant", "r.location_type", "r.state", "r.postal_code", "r.transaction_quantity", "r.transaction_amount",
    ).filter((F.col("state") != "") & (F.col("postal_code") != "") & (F.col("location_type") != ""))


def market_feed_enrich(rows: DataFrame, postal_codes: DataFrame) -> DataFrame:
    """Place of the postal code; rows of an unknown city are dropped."""
    places = postal_codes.select("postal_code", "city", "region")
    return first_per_key(rows, MARKET_KEY).join(places, "postal_code", "left").filter(F.col("city").isNotNull()).select(
        "date", "merchant", F.upper("location_type").alias("location_type"), "state", "postal_code",
        "transaction_quantity", "transaction_amount", F.initcap("city").alias("city"),
        F.coalesce("region", F.lit("Unknown")).alias("region"),
    )


def market_feed_categorise(rows: DataFrame, merchants: DataFrame, location_types: DataFrame) -> DataFrame:
    """The merchant's categories, else the location type's, else 'Other'."""
    by_merchant = merchants.select(
        "merchant", "location_type", F.col("industry_category").alias("_mi"), F.col("cuisine_category").alias("_mc")
    )
    by_type = location_types.select(
        "location_type", F.col("industry_category").alias("_ti"), F.col("cuisine_category").alias("_tc")
    )

    def choose(first: str, second: str) -> Column:
        return F.coalesce(F.nullif(F.col(first), F.lit("Other")), F.col(second), F.lit("Other"))

    return rows.join(by_merchant, ["merchant", "location_type"], "left").join(by_type, "location_type", "left").select(
        "date", "merchant", "location_type",
        choose("_mi", "_ti").alias("industry_category"), choose("_mc", "_tc").alias("cuisine_category"),
        "state", "postal_code", "transaction_quantity", "transaction_amount", "city", "region",
    )


def market_feed_merge(stored: DataFrame, rows: DataFrame) -> DataFrame:
    return merge_upsert(stored, rows, MARKET_KEY)


# ---- persons ------------------------------------------------------------------------


def _person_set(raw: DataFrame, feed_date: str, value: str, out: str) -> DataFrame:
    once = raw.filter((F.col("feed_date") == feed_date) & F.col(value).isNotNull()).groupBy("person_id", value).agg(
        F.max("household_id").alias("household_id")
    )
    return once.groupBy("person_id").agg(
        F.max("household_id").alias("household_id"), F.array_sort(F.collect_set(value)).alias(out)
    )


def person_emails(raw: DataFrame, feed_date: str) -> DataFrame:
    return _person_set(raw, feed_date, "sha256_lower_email", "sha256_lower_emails")


def person_devices(raw: DataFrame, feed_date: str) -> DataFrame:
    return _person_set(raw, feed_date, "native_maid", "native_maids")


def person_geo(raw: DataFrame, feed_date: str) -> DataFrame:
    rows = raw.filter((F.col("feed_date") == feed_date) & F.col("zip").isNotNull())
    return first_per_key(rows.drop("feed_date", "file_name", "source_id"), ["person_id"]).withColumn(
        "zip_code", fields.zip_code(F.col("zip"))
    ).drop("zip")


# ---- coded attributes ---------------------------------------------------------------

# fixed values
TRUE_WORDS = ["true", "y", "yes", "1", "t"]
FALSE_WORDS = ["false", "n", "no", "0", "f"]
UNKNOWN_WORDS = ["u", "unknown"]


def boolean_word(value: Column) -> Column:
    """True, false or null for the unknown words; any other word fails the job."""
    word = F.lower(value)
    return (
        F.when(word.isin(TRUE_WORDS), F.lit(True))
        .when(word.isin(FALSE_WORDS), F.lit(False))
        .when(value.isNull() | word.isin(UNKNOWN_WORDS), F.lit(None).cast("boolean"))
        .otherwise(F.raise_error(F.concat(F.lit("not a boolean word: "), value)).cast("boolean"))
    )


def coded_columns(df: DataFrame, keep: list[str], boolean: list[str], integer: list[str], categories: list[str]) -> list[str]:
    """Columns to decode by dictionary; fails when a column has no rule at all."""
    rest = [c for c in df.columns if c not in {*keep, *boolean, *integer}]
    unknown = [c for c in rest if c not in categories]
    if unknown:
        raise ValueError(f"no rule for columns {unknown}: keep, boolean, integer or a dictionary category")
    return rest


MOST_CODES = 100_000  # entries of a dictionary


def code_maps(dictionary: DataFrame, categories: list[str], most: int = MOST_CODES) -> DataFrame:
    """One row with one column: a map from category to a map from code to value.

    Fails when a (category, code) has two values, and for more than `most` entries, as the row goes to every task.
    """
    entries = dictionary.filter(F.col("code_category").isin(categories) & F.col("code").isNotNull()).select(
        "code_category", F.col("code").cast("string").alias("code"), "code_value"
    ).distinct()
    total = F.sum(F.size("codes"))
    listed = entries.groupBy("code_category").agg(F.map_from_entries(F.collect_list(F.struct("code", "code_value"))).alias("codes"))
    maps = F.map_from_entries(F.collect_list(F.struct("code_category", "codes")))
    kind = "map<string,map<string,string>>"
    refused = F.raise_error(F.lit(f"the dictionary has more than {most} entries")).cast(kind)
    return listed.agg(F.when(total > most, refused).otherwise(maps.cast(kind)).alias("maps"))


def person_attributes_decode(
    raw: DataFrame, dictionary: DataFrame, keep: list[str], boolean: list[str], integer: list[str], categories: list[str], most: int = MOST_CODES
) -> DataFrame:
    """Keep, boolean word, strict integer or dictionary value, column by column.

    dictionary: code_category, code, code_value. However many columns are coded, the dictionary is read once, as one value that
    every row looks its codes up in (see code_maps), and the plan has no join; a code without an entry becomes null.
    """
    coded = coded_columns(raw, keep, boolean, integer, categories)
    maps = code_maps(dictionary, coded, most).scalar() if coded else None
    return raw.select(
        *[
            boolean_word(F.col(c)).alias(c) if c in boolean
            else F.col(c).cast("int").alias(c) if c in integer
            else F.try_element_at(F.try_element_at(maps, F.lit(c)), F.col(c).cast("string")).alias(c) if c in coded
            else F.col(c)
            for c in raw.columns
        ]
    )


def validate_codes(raw: DataFrame, dictionary: DataFrame, coded: list[str]) -> DataFrame:
    """Every (category, code) pair that has no dictionary entry, with the number of cells it stands in."""
    cells = F.array(*[F.struct(F.lit(c).alias("code_category"), F.col(c).cast("string").alias("code")) for c in coded])
    used = raw.select(F.inline(cells)).filter(F.col("code").isNotNull()).groupBy("code_category", "code").agg(F.count(F.lit(1)).alias("cells"))
    return used.join(dictionary, ["code_category", "code"], "left_anti")


def require_no_rejects(rejects: DataFrame, named: int = 100) -> None:
    """Fail if there is any rejected pair; the message names the first ones only."""
    bad = rejects.orderBy("code_category", "code").limit(named).collect()
    if bad:
        raise ValueError(f"codes missing from the dictionary, the first {named} at most: {[tuple(r) for r in bad]}")


def person_attributes_merge(stored: DataFrame, decoded: DataFrame) -> DataFrame:
    return merge_upsert(stored, decoded, ["person_id"])
