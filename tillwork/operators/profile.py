"""Customer profile documents from the signal tables and the signal catalogue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes

GENERAL = "general_customer_signal"
PARTNER_LOCATION = "specific_partner_location_signal"
SIGNAL_COLUMNS = ["partner_id", "location_id", "date_option", "customer_360_id", "signal_domain", "signal_name", "signal_value"]
PLACE = ["customer_360_id", "section", "partner_id", "location_id"]


def active_signal_catalogue(catalogue: DataFrame, signal_type: str | None = None) -> DataFrame:
    """Active entries of a type: domain_name, signal_name, es_type, section."""
    rows = catalogue.filter("is_active")
    return rows if signal_type is None else rows.filter(F.col("signal_type") == signal_type)


def catalogue_values(catalogue: DataFrame, column: str, most: int = 10_000) -> list[str]:
    """Distinct names of the catalogue (a configuration table), to fix pivot columns.

    They come to the driver and become columns; a catalogue with more than `most` of them is refused,
    never cut.
    """
    names = [r[0] for r in catalogue.select(column).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} different {column} in the signal catalogue")
    return sorted(names)


def latest_weekly_signals(weekly: DataFrame, feed_date: str) -> DataFrame:
    """Of the last seven days, the newest generation of every signal."""
    day = dt.date.fromisoformat(feed_date)
    week = weekly.filter(F.col("signal_generation_date").between(F.lit(day - dt.timedelta(days=7)), F.lit(day)))
    key = ["signal_domain", "signal_name"]
    newest = week.groupBy(*key).agg(F.max("signal_generation_date").alias("signal_generation_date"))
    return week.join(newest, [*key, "signal_generation_date"]).select(*SIGNAL_COLUMNS)


def daily_signals(daily: DataFrame, feed_date: str, columns: list[str] | None = None) -> DataFrame:
    rows = daily.filter(F.col("signal_generation_date") == F.lit(feed_date).cast("date"))
    return rows.select(*(columns or [c for c in rows.columns if c != "signal_generation_date"]))


def recognised_signals(signals: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Signals the catalogue knows, named signal_type, with their section."""
    known = catalogue.select("domain_name", "signal_name", "es_type", "section")
    rows = signals.withColumnRenamed("signal_domain", "domain_name").join(known, ["domain_name", "signal_name"])
    others = [c for c in signals.columns if c not in ("signal_domain", "signal_name")]
    return rows.select("domain_name", "section", *others, F.concat_ws("_", "signal_name", "es_type").alias("signal_es_name"))


def domain_pivot(rows: DataFrame, keys: list[str], domains: list[str]) -> DataFrame:
    """One column per domain with the sorted (name, value) list of the key."""
    named = F.struct("signal_es_name", F.col("signal_value").cast("string").alias("signal_value"))
    return rows.groupBy(*keys).pivot("domain_name", domains).agg(F.array_sort(F.collect_set(named)))


def lists_to_maps(pivoted: DataFrame, domains: list[str]) -> DataFrame:
    """Name to value maps; an empty list becomes null. The smallest value of a name wins."""

    def as_map(name: str) -> Column:
        pairs = F.col(f"`{name}`")
        names = F.array_distinct(F.transform(pairs, lambda p: p["signal_es_name"]))
        first = F.transform(
            names, lambda n: F.get(F.filter(pairs, lambda p: p["signal_es_name"] == n), F.lit(0))["signal_value"]
        )
        return F.when(F.size(pairs) > 0, F.map_from_arrays(names, first))

    return pivoted.withColumns({d: as_map(d) for d in domains})


def _domain_map(domains: list[str]) -> Column:
    pairs = [part for d in domains for part in (F.lit(d), F.col(f"`{d}`"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def generic_profile(signals: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per customer with a column per section: domain -> name -> value."""
    entries = active_signal_catalogue(catalogue, GENERAL)
    domains, sections = catalogue_values(entries, "domain_name"), catalogue_values(entries, "section")
    rows = recognised_signals(signals, entries)
    maps = lists_to_maps(domain_pivot(rows, ["customer_360_id", "section"], domains), domains)
    by_section = maps.groupBy("customer_360_id").agg(
        F.map_from_entries(F.collect_list(F.struct("section", _domain_map(domains)))).alias("sections")
    )
    return by_section.select("customer_360_id", *[F.element_at("sections", F.lit(s)).alias(s) for s in sections])


def partner_location_profile(signals: DataFrame, catalogue: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per customer; per section a list of stores with a map per time period."""
    entries = active_signal_catalogue(catalogue, PARTNER_LOCATION)
    domains, sections = catalogue_values(entries, "domain_name"), catalogue_values(entries, "section")
    rows = recognised_signals(signals, entries)
    maps = lists_to_maps(domain_pivot(rows, [*PLACE, "date_option"], domains), domains)
    periods = maps.groupBy(*PLACE).agg(
        F.map_from_entries(F.collect_list(F.struct("date_option", _domain_map(domains)))).alias("periods")
    )
    named = periods.join(locations.select("partner_id", "location_id", "location_nm"), ["partner_id", "location_id"], "left")
    entry = F.struct(
        F.col("partner_id").alias("partner_id_keyword"),
        F.col("location_id").alias("location_id_keyword"),
        F.coalesce("location_nm", "location_id").alias("location_name_keyword"),
        *[F.element_at("periods", F.lit(p)).alias(p) for p in codes.PERIODS],
    )
    return named.groupBy("customer_360_id").pivot("section", sections).agg(F.collect_list(entry))


def customer_profile(customer_360: DataFrame, generic: DataFrame, partner_location: DataFrame) -> DataFrame:
    people = customer_360.filter("active_flag").select("customer_360_id", F.col("identities").alias("customer_identities"))
    return people.join(generic, "customer_360_id", "left").join(partner_location, "customer_360_id", "left")
