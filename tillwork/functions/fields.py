"""Column builders that clean single fields: contacts, money, places, dates and times."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL_PATTERN = (
    r"^[A-Za-z0-9!#$%&'*+/=?^_{|}~-]+(\.[A-Za-z0-9!#$%&'*+/=?^_{|}~-]+)*"
    r"@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}$"
)


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def email(value: Column) -> Column:
    clean = blank_to_null(value)
    return F.when(clean.rlike(EMAIL_PATTERN), F.lower(clean))


def phone(value: Column) -> Column:
    """North American number as 11 digits, or null."""
    clean = blank_to_null(value)
    # one separator group between digits: a dash or dot run of two is not a phone number
    well_formed = clean.rlike(r"^\+?[(]?[0-9]([ .()/-]{0,2}[0-9])*$") & ~clean.rlike(r"--|\.\.")
    digits = F.regexp_replace(clean, "[^0-9]", "")
    with_country = F.when(
        (F.length(digits) == 10) & ~clean.startswith("+"), F.concat(F.lit("1"), digits)
    ).when(F.length(digits) == 11, digits)
    return F.when(well_formed & with_country.rlike("^1[2-9][0-9]{2}[2-9][0-9]{6}$"), with_country)


def advertiser_id(value: Column) -> Column:
    return F.upper(blank_to_null(value))


def zip_code(value: Column) -> Column:
    return F.nullif(F.regexp_extract(value, r"^(\d{5})(-\d{4})?$", 1), F.lit(""))


def city_text(value: Column) -> Column:
    """Escape sequences and raw control characters removed."""
    unescaped = F.regexp_replace(value, r"\\[btnfr]", "")
    return F.regexp_replace(unescaped, r"[\x00-\x1f]", "")


def cents_to_money(cents: Column) -> Column:
    amount = blank_to_null(cents.cast("string")).try_cast("decimal(20,6)")
    return (amount * F.lit(Decimal("0.01"))).try_cast("decimal(9,2)")  # exact, and half the time of a division


def squeeze_spaces(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), " +", " ")


def to_date_or_null(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def iso_timestamp(text: Column, zone: str | None = None) -> Column:
    """ISO text to an instant; a given zone overrides the offset in the text."""
    if zone is None:
        return F.try_to_timestamp(text)
    local = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.to_utc_timestamp(F.try_to_timestamp(local), zone)


def pattern_timestamp(text: Column, pattern: str, zone: str | None = None) -> Column:
    parsed = F.try_to_timestamp(text, F.lit(pattern))
    return parsed if zone is None else F.to_utc_timestamp(parsed, zone)


def epoch_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("bigint"))


def local_time(instant: Column, zone: Column) -> Column:
    return F.from_utc_timestamp(instant, F.coalesce(zone, F.lit("UTC")))


def year_week_to_date(year_week: Column) -> Column:
    """'YYYY-WW': first Saturday of January plus WW weeks, less one day."""
    year = F.substring(year_week, 1, 4).try_cast("int")
    week = F.substring(year_week, 6, 2).try_cast("int")
    first_saturday = F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1), "SAT")
    return F.date_add(first_saturday, week * 7 - 1)


# ---- hashing ------------------------------------------------------------------------


def salted_hash(value: Column, salt: str) -> Column:
    """64 hex digits of SHA-256 over the trimmed value and the salt; blank gives null."""
    clean = blank_to_null(value)
    return F.sha2(F.concat(clean, F.lit(salt)), 256)


def identity_metadata(identity_type: Column, original: Column) -> Column:
    """Phone: first four digits; e-mail: the domain; anything else an empty map."""
    empty = F.create_map().cast("map<string,string>")
    has_area = (identity_type == "phone") & (F.length(original) >= 4)
    has_domain = (
        (identity_type == "email") & original.contains("@") & ~original.endswith("@")
    )
    domain = F.regexp_extract(original, "^[^@]*@(.*)$", 1)
    return (
        F.when(has_area, F.create_map(F.lit("phone_area_code"), F.substring(original, 1, 4)))
        .when(has_domain, F.create_map(F.lit("email_domain"), domain))
        .otherwise(empty)
    )


def qualified_identity(identity_type: Column, identity_id: Column) -> Column:
    return F.concat(identity_type, F.lit(":"), identity_id)


def identity_type_of(qualified: Column) -> Column:
    return F.substring_index(qualified, ":", 1)


def identity_id_of(qualified: Column) -> Column:
    """Everything after the first colon, so that IPv6 values survive."""
    return F.regexp_extract(qualified, r"(?s)^[^:]*:(.*)$", 1)
