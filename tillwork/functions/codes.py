"""Fixed code lists and the column builders that map vendor values onto them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------

ORDER_STATE = {"Unknown": 0, "Open": 1, "Draft": 2, "Cancelled": 3, "Completed": 4, "Other": 99}
TENDER = {"Unknown": 0, "Cash": 1, "CreditCard": 2, "GiftCard": 3, "Wallet": 4, "Other": 99}
CHANNEL = {
    "Unknown": 0, "PhysicalLane": 1, "PhysicalKiosk": 2, "PhysicalPickup": 3,
    "PhysicalDelivery": 4, "DigitalWeb": 5, "DigitalApp": 6, "Other": 99,
}
LOCATION_TYPE = {
    "Unknown": 0, "Restaurant": 1, "C-Store": 2, "Hotel": 3, "Bar": 4, "Website": 5, "Mobile": 6,
    "Other": 99,
}

EMAIL = "email"
PHONE = "phone"
CARD_BIN = "combination-bin"
CARD_NAME = "combination-card"
CARD_HOLDER = "card-holder-name-type-number"
CARD_SLIM = "combination-card-slim"
IPV4 = "ipv4"
IPV6 = "ipv6"
MAID_IDFA = "MAID-IDFA"
MAID_AAID = "MAID-AAID"
MAID_UNKNOWN = "MAID-UNKNOWN"
PERSON_ID = "person-id"
POS_CUSTOMER_ID = "pos-customer-id"

SQUARE_STATE = {"DRAFT": 2, "COMPLETED": 4, "OPEN": 1, "CANCELLED": 3}
SQUARE_TENDER = {"CARD": 2, "CASH": 1, "NO_SALE": 99, "OTHER": 99, "WALLET": 4, "SQUARE_GIFT_CARD": 3}
TOAST_STATE = {"NEEDS_APPROVAL": 1, "FUTURE": 2, "NOT_APPROVED": 3, "APPROVED": 4}
TOAST_TENDER = {
    "CREDIT": 2, "CASH": 1, "HOUSE_ACCOUNT": 99, "OTHER": 99, "LEVELUP": 99, "UNDETERMINED": 0,
    "REWARDCARD": 3, "GIFTCARD": 3,
}
TOAST_TARGET = {"DINE_IN": 1, "TAKE_OUT": 3, "DELIVERY": 4}
TOAST_ORIGINATE = {"DINE_IN": 1, "TAKE_OUT": 3}
OMNIVORE_STATE = {"COMPLETED": 4, "OPEN": 1, "CANCELLED": 3, "UNKNOWN": 0}
OMNIVORE_TENDER = {"CARD": 2, "CASH": 1, "NO_SALE": 99, "OTHER": 99, "3RD PARTY": 99, "WALLET": 4}
PARBRINK_TENDER = {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 99, 6: 4, 7: 99, 8: 2}
PARBRINK_ORIGINATE = {
    "FORHERE": 1, "TAKEOUT": 0, "PICKUP": 1, "DELIVERY": 0, "UBEREATS": 6, "CNUSD": 0,
    "ONLINEPICKUP": 5, "POSTMATES": 6, "GRUBHUB": 6, "CATERING": 0, "OFFICEEXPRESS": 6,
    "DOORDASH": 6, "DRIVETHRU": 1, "FOODRUNNERS": 6, "CURBSIDE": 5, "TOGO": 1,
}
PARBRINK_TARGET = {
    "FORHERE": 1, "TAKEOUT": 3, "PICKUP": 3, "DELIVERY": 4, "UBEREATS": 4, "CNUSD": 0,
    "ONLINEPICKUP": 3, "POSTMATES": 4, "GRUBHUB": 4, "CATERING": 4, "OFFICEEXPRESS": 4,
    "DOORDASH": 4, "DRIVETHRU": 3, "FOODRUNNERS": 4, "CURBSIDE": 3, "TOGO": 3,
}
CARD_BRAND = {
    0: "None", 1: "MasterCard", 2: "Visa", 3: "American Express", 4: "Diners Club",
    5: "Discover", 6: "enRoute", 7: "JCB", 8: "Private",
}
MENU_ITEM_TYPE = {
    0: "Normal", 1: "Pizza", 2: "Chicken", 3: "GiftCard", 4: "Composite", 5: "LoyaltyItem",
    6: "Prepaid",
}
# fixed values: the zone of every zone code
TIMEZONE = {
    1: "Pacific/Honolulu", 2: "America/Anchorage", 3: "America/Los_Angeles", 4: "America/Phoenix",
    5: "America/Denver", 6: "America/Chicago", 7: "America/Cancun", 8: "America/Halifax",
    9: "America/Winnipeg", 10: "America/Adak", 11: "Pacific/Easter", 12: "America/Bogota",
    13: "America/Port-au-Prince", 14: "America/New_York", 15: "America/St_Johns", 16: "America/Miquelon",
    17: "America/Noronha", 18: "Pacific/Guam", 19: "Etc/GMT+12", 20: "Pacific/Pago_Pago",
    21: "Pacific/Marquesas", 22: "Pacific/Gambier", 23: "America/Tijuana", 24: "Pacific/Pitcairn",
    25: "America/Hermosillo", 26: "America/Guatemala", 27: "America/Mexico_City", 28: "America/Cancun",
    29: "America/Havana", 30: "America/Grand_Turk", 31: "America/Asuncion", 32: "America/Caracas",
    33: "America/Cuiaba", 34: "America/La_Paz", 35: "America/Santiago", 36: "America/Araguaina",
    37: "America/Sao_Paulo", 38: "America/Cayenne", 39: "America/Argentina/Buenos_Aires",
    40: "America/Nuuk", 41: "America/Montevideo", 42: "America/Punta_Arenas", 43: "America/Bahia",
    44: "America/Noronha", 45: "Atlantic/Azores", 46: "Atlantic/Cape_Verde", 47: "UTC", 48: "Europe/London",
    49: "Etc/Greenwich", 50: "Africa/Sao_Tome", 51: "Africa/Casablanca", 52: "WET", 53: "Europe/Budapest",
    54: "Europe/Paris", 55: "Europe/Warsaw", 56: "Africa/Lagos", 57: "Asia/Amman", 58: "Europe/Bucharest",
    59: "Asia/Beirut", 60: "Africa/Cairo", 61: "Europe/Chisinau", 62: "Asia/Damascus", 63: "Asia/Hebron",
    64: "Africa/Johannesburg", 65: "Europe/Kiev", 66: "Asia/Jerusalem", 67: "Europe/Kaliningrad",
    68: "Africa/Khartoum", 69: "Africa/Tripoli", 70: "Africa/Windhoek", 71: "Asia/Baghdad",
    72: "Europe/Istanbul", 73: "Asia/Riyadh", 74: "Europe/Minsk", 75: "Europe/Moscow", 76: "Africa/Nairobi",
    77: "Asia/Tehran", 78: "Asia/Dubai", 79: "Europe/Astrakhan", 80: "Asia/Baku", 81: "Europe/Samara",
    82: "Indian/Mauritius", 83: "Europe/Saratov", 84: "Asia/Tbilisi", 85: "Europe/Volgograd",
    86: "Asia/Yerevan", 87: "Asia/Kabul", 88: "Asia/Tashkent", 89: "Asia/Yekaterinburg", 90: "Asia/Karachi",
    91: "Asia/Qyzylorda", 92: "Asia/Kolkata", 93: "Asia/Colombo", 94: "Asia/Kathmandu",
    95: "Asia/Novosibirsk", 96: "Asia/Dhaka", 97: "Asia/Omsk", 98: "Asia/Yangon", 99: "Asia/Bangkok",
    100: "Asia/Barnaul", 101: "Asia/Hovd", 102: "Asia/Krasnoyarsk", 103: "Asia/Novosibirsk",
    104: "Asia/Tomsk", 105: "Asia/Shanghai", 106: "Asia/Irkutsk", 107: "Asia/Singapore",
    108: "Australia/Perth", 109: "Asia/Taipei", 110: "Asia/Ulaanbaatar", 111: "Australia/Eucla",
    112: "Asia/Chita", 113: "Asia/Tokyo", 114: "Asia/Pyongyang", 115: "Asia/Seoul", 116: "Asia/Yakutsk",
    117: "Australia/Adelaide", 118: "Australia/Darwin", 119: "Australia/Brisbane", 120: "Australia/Sydney",
    121: "Australia/Hobart", 122: "Asia/Vladivostok", 123: "Australia/Lord_Howe",
    124: "Pacific/Bougainville", 125: "Asia/Srednekolymsk", 126: "Asia/Magadan", 127: "Pacific/Norfolk",
    128: "Asia/Sakhalin", 129: "Pacific/Guadalcanal", 130: "Asia/Kamchatka", 131: "Pacific/Auckland",
    132: "Pacific/Tarawa", 133: "Pacific/Fiji", 134: "Asia/Kamchatka", 135: "Pacific/Chatham",
    136: "Etc/GMT-13", 137: "Pacific/Tongatapu", 138: "Pacific/Apia", 139: "Pacific/Kiritimati",
}

SQUARE_WEB_SOURCES = ["Popmenu", "Square Online"]
SQUARE_APP_SOURCES = ["Doordash", "Ubereats", "Grubhubweb"]

PERIODS = {"time_period_7": 7, "time_period_30": 30, "time_period_60": 60, "time_period_90": 90}
ALL_LOCATIONS = "_ALL"

# ---- column builders ----------------------------------------------------------------


def lookup(key: Column, mapping: dict) -> Column:
    """Literal map lookup; null for a missing or null key."""
    literals = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.element_at(literals, key)


def _blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def conform_text(value: Column, mapping: dict[str, int]) -> Column:
    """Trimmed upper-case text to code: blank gives 0, unmapped gives 99."""
    clean = F.upper(_blank_to_null(value))
    return F.when(clean.isNull(), F.lit(0)).otherwise(F.coalesce(lookup(clean, mapping), F.lit(99)))


def conform_int(value: Column, mapping: dict[int, int]) -> Column:
    code = value.try_cast("int")
    return F.when(code.isNull(), F.lit(0)).otherwise(F.coalesce(lookup(code, mapping), F.lit(99)))


def first_rule(*rules: tuple[Column, int], default: int) -> Column:
    """The code of the first condition that holds."""
    chained = None
    for condition, code in rules:
        chained = (F if chained is None else chained).when(condition, F.lit(code))
    return chained.otherwise(F.lit(default))


def starts_with_any(value: Column, prefixes: list[str]) -> Column:
    """False for null, as a missing source name matches no prefix."""
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.coalesce(value.startswith(prefix), F.lit(False))
    return hit


def square_originate(source_name: Column) -> Column:
    return first_rule(
        (starts_with_any(source_name, SQUARE_WEB_SOURCES), CHANNEL["DigitalWeb"]),
        (starts_with_any(source_name, SQUARE_APP_SOURCES), CHANNEL["DigitalApp"]),
        default=CHANNEL["PhysicalLane"],
    )


def square_target(source_name: Column, fulfillments: Column) -> Column:
    """Delivery by source; else the first typed fulfilment, completed ones first."""
    typed = F.filter(fulfillments, lambda f: f["type"].isNotNull())
    done = F.filter(typed, lambda f: F.coalesce(f["state"] == "COMPLETED", F.lit(False)))
    kind = F.coalesce(F.get(done, F.lit(0))["type"], F.get(typed, F.lit(0))["type"])
    return first_rule(
        (starts_with_any(source_name, SQUARE_WEB_SOURCES + SQUARE_APP_SOURCES), CHANNEL["PhysicalDelivery"]),
        (kind == "PICKUP", CHANNEL["PhysicalPickup"]),
        default=CHANNEL["Unknown"],
    )


def toast_channel(behaviour: Column, mapping: dict[str, int]) -> Column:
    return F.when(behaviour.isNull(), F.lit(0)).otherwise(
        F.coalesce(lookup(F.upper(behaviour), mapping), F.lit(99))
    )


def omnivore_originate(name: Column) -> Column:
    return first_rule(
        (name.isin("Dine In", "Eat In", "Carry Out"), CHANNEL["PhysicalLane"]),
        (name.isin("Delivery", "Order Ahead"), CHANNEL["Other"]),
        default=CHANNEL["Unknown"],
    )


def omnivore_target(name: Column) -> Column:
    return first_rule(
        (name.isin("Dine In", "Eat In", "Order Ahead"), CHANNEL["PhysicalLane"]),
        (name == "Delivery", CHANNEL["PhysicalDelivery"]),
        (name == "Carry Out", CHANNEL["PhysicalPickup"]),
        default=CHANNEL["Unknown"],
    )


def parbrink_channel(destination: Column, mapping: dict[str, int]) -> Column:
    return conform_text(F.regexp_replace(destination, "[^a-zA-Z]+", ""), mapping)


def omnivore_state(is_open: Column, is_void: Column) -> Column:
    """Both flags are the texts true/false; anything else is unknown."""
    flags = ("true", "false")
    known = is_open.isin(*flags) & is_void.isin(*flags)
    return first_rule(
        (known & (is_void == "true"), ORDER_STATE["Cancelled"]),
        (known & (is_open == "true"), ORDER_STATE["Open"]),
        (known, ORDER_STATE["Completed"]),
        default=ORDER_STATE["Unknown"],
    )


def closed_flag_state(is_closed: Column) -> Column:
    flag = F.lower(is_closed)
    return first_rule(
        (flag == "true", ORDER_STATE["Completed"]),
        (flag == "false", ORDER_STATE["Open"]),
        default=ORDER_STATE["Unknown"],
    )


def location_type_name(code: Column) -> Column:
    names = {v: k for k, v in LOCATION_TYPE.items()}
    return F.coalesce(lookup(code, names), F.lit("Unknown"))
