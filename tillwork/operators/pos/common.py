"""What the profiles share: the record projector, the order-line layout, identity rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes, fields
from tillwork.operators.keyed import all_of, first_per_key
from tillwork.operators.privacy import Rule, pseudonymise_columns
from tillwork.session import stored_once
from tillwork.sources.typed_landing import TypedLanding

Expression = str | Callable[[], Column]


@dataclass(frozen=True)
class RecordSpec:
    """How one record type becomes a table.

    schema: DDL of the fields read from record_value, parsed once as r.
    explode: (name, array expression) in turn; where: filter after the explodes.
    columns: output name to expression; nulls: typed null columns; key: one row per key
    (within the partner), the smallest by order_by.
    """

    record_type: str
    schema: str
    columns: dict[str, Expression]
    key: tuple[str, ...]
    explode: tuple[tuple[str, str], ...] = ()
    where: str | None = None
    nulls: dict[str, str] = field(default_factory=dict)
    order_by: tuple[str, ...] | None = None


def column(expression: Expression) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression()


def strings(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


def readers(*uses: RecordSpec | tuple[str, str]) -> list[tuple[str, str]]:
    """Record type and schema of every reader, for a typed landing."""
    return [(u.record_type, u.schema) if isinstance(u, RecordSpec) else u for u in uses]


def parsed(raw: DataFrame | TypedLanding, record_type: str, schema: str, feed_date: str | None) -> DataFrame:
    """Records of one type (and feed date) with their payload as struct r, parsed here or when they landed.

    The predicates are plain ones on the raw columns, so partitions are pruned; None reads all
    feed dates. The payload leaves through a one-element explode: that keeps the optimizer from
    copying from_json into every filter and field above it, so a record is parsed once.
    """
    if isinstance(raw, TypedLanding):
        return raw.records(record_type, schema, feed_date)
    rows = raw.filter((F.col("record_type") == record_type) & F.col("record_value").isNotNull())
    if feed_date is not None:
        rows = rows.filter(F.col("feed_date") == feed_date)
    others = [n for n in raw.columns if n not in ("record_value", "record_type", "feed_date")]
    return rows.select(*others, F.explode(F.array(F.from_json("record_value", schema))).alias("r"))


def exploded(rows: DataFrame, *steps: tuple[str, str]) -> DataFrame:
    for name, expression in steps:
        rows = rows.withColumn(name, F.explode(F.expr(expression)))
    return rows


def project_records(raw: DataFrame | TypedLanding, spec: RecordSpec, partner_id: str, feed_date: str | None) -> DataFrame:
    rows = exploded(parsed(raw, spec.record_type, spec.schema, feed_date), *spec.explode)
    if spec.where is not None:
        rows = rows.filter(spec.where)
    table = rows.select(
        F.lit(partner_id).alias("partner_id"),
        *[column(e).alias(name) for name, e in spec.columns.items()],
        *[F.lit(None).cast(t).alias(name) for name, t in spec.nulls.items()],
    )
    order_by = list(spec.order_by) if spec.order_by else None
    return first_per_key(table, ["partner_id", *spec.key], order_by)


def with_place(locations: DataFrame, postal_codes: DataFrame) -> DataFrame:
    """City, state and region of the zip code."""
    places = postal_codes.select(F.col("postal_code").alias("zip_code"), "city", "state_code", "region")
    return locations.join(places, "zip_code", "left")


# ---- order lines --------------------------------------------------------------------

# column layout of an order line; a profile leaves out what it does not know
ORDER_LINE = {
    "ord_id": "string", "ord_desc": "string", "ord_total": "decimal(12,2)", "ord_date": "date",
    "ord_timestamp": "timestamp", "discount_amount": "decimal(12,2)", "partner_id": "string",
    "location_id": "string", "ord_state_id": "int", "ord_type": "string",
    "ord_originate_channel_id": "int", "ord_target_channel_id": "int", "item_quantity": "decimal(12,2)",
    "item_total": "decimal(12,2)", "emp_id": "string", "discount_id": "string", "dsp_qty": "string",
    "dsp_ttl": "string", "guest_check_line_item_id": "string", "line_id": "string",
    "taxes_id": "array<string>", "taxes_amount": "decimal(12,2)", "item_id": "string",
    "item_price_id": "string", "reason_code_id": "string", "service_charge_id": "string",
    "service_charge_amount": "decimal(12,2)", "total_taxes_amount": "decimal(12,2)",
    "total_tip_amount": "decimal(12,2)", "tender_ids": "array<string>", "ord_pay_total": "decimal(12,2)",
    "ord_sub_total": "decimal(12,2)", "feed_date": "date",
}


def order_lines(
    rows: DataFrame, known: dict[str, Expression], feed_date: str | None, unnest: tuple[str, str] | None = None,
    of_line: dict[str, Expression] | None = None,
) -> DataFrame:
    """Rows in the order-line layout; lines without a time or date are dropped.

    With unnest (name, array expression) rows hold whole orders: known is made once per order, then the lines are unnested, and
    of_line is made of each. What an order's lines share is then not made for each of them, and its payload does not follow them.
    """
    known = {"feed_date": lambda: F.lit(feed_date).cast("date"), **known}
    if unnest is None:
        return _laid_out(rows.select(*_typed(known)))
    name, array = unnest
    return _unnested(rows.select(*_typed(known), F.expr(array).alias("_lines")), name, of_line or {})


def _typed(values: dict[str, Expression]) -> list[Column]:
    return [column(e).try_cast(ORDER_LINE[name]).alias(name) for name, e in values.items()]


def _laid_out(lines: DataFrame) -> DataFrame:
    there = lines.columns
    layout = [F.col(name) if name in there else F.lit(None).cast(t).alias(name) for name, t in ORDER_LINE.items()]
    more = [n for n in there if n not in ORDER_LINE]
    return lines.select(*layout, *more).filter("ord_timestamp IS NOT NULL AND ord_date IS NOT NULL")


def _unnested(orders: DataFrame, name: str, of_line: dict[str, Expression]) -> DataFrame:
    known = [n for n in orders.columns if n != "_lines"]
    return _laid_out(orders.select(*known, F.explode("_lines").alias(name)).select(*known, *_typed(of_line)))


def with_identities(lines: DataFrame, by_order: DataFrame) -> DataFrame:
    return lines.join(by_order, ["ord_id", "location_id"], "left")


def once_and_again(rows: DataFrame, keys: list[Column], items: Column) -> tuple[DataFrame, DataFrame]:
    """The records that come once by their keys and list no item twice, and the others: only these have anything to choose.

    The others' keys are found by an aggregation, stored, and broadcast where few. Reads the records twice: they should be stored.
    """
    twice = F.coalesce(F.size(F.array_distinct(items)) < F.size(items), F.lit(False))
    names = [f"_key_{i}" for i in range(len(keys))]
    found = rows.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)]).agg((F.max(twice) | (F.count(F.lit(1)) > 1)).alias("_again"))
    repeated = stored_once(found.filter("_again").drop("_again"), "repeated")
    same = all_of([k.eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    return rows.join(repeated, same, "left_anti"), rows.join(repeated, same, "left_semi")


ORDER_ITEM = ["partner_id", "location_id", "ord_id", "ord_date", "item_id"]


def order_table(
    rows: DataFrame, stored: bool, by_order: DataFrame, known: dict[str, Expression], feed_date: str | None,
    unnest: tuple[str, str], of_line: dict[str, Expression], order_by: list[str], key: list[str] = ORDER_ITEM, items: str | None = None,
    each: Callable[[DataFrame], DataFrame] = lambda orders: orders, one: Callable[[DataFrame], DataFrame] = lambda orders: orders,
) -> DataFrame:
    """The order lines with their order's identities, one per key (order and item): the smallest by order_by.

    Where the records are stored (landed, or as text), orders that come once and list no item twice have nothing to choose: they meet their
    identities whole, before their lines are unnested, so no line of theirs is shuffled or sorted. The lines of the other orders are reduced
    (once_and_again), as all lines are where finding such orders would make every record once more.

    items: an order's items (default: by of_line); each: orders to the rows that known is made of; one: records that come again to one per order.
    """
    name, array = unnest
    known = {"feed_date": lambda: F.lit(feed_date).cast("date"), **known}

    def whole(of: DataFrame) -> DataFrame:
        return each(of).select(*_typed(known), F.expr(array).alias("_lines"))

    def chosen(of: DataFrame) -> DataFrame:
        return with_identities(first_per_key(_unnested(whole(one(of)), name, of_line), key, order_by), by_order)

    if not stored:
        return chosen(rows)
    order = [column(known[n]).try_cast("string") for n in ("ord_id", "location_id")]
    come_once, again = once_and_again(rows, order, F.expr(items or array + of_line["item_id"].removeprefix(name)))
    once = _unnested(with_identities(whole(come_once), by_order), name, of_line)
    others = chosen(again)
    return once.select(others.columns).unionByName(others)


# ---- identities ---------------------------------------------------------------------

IDENTITY = ["ord_id", "location_id", "identity_id", "type", "weight"]


def identity(value: Column, kind: str, weight: int) -> Column:
    return F.struct(value.alias("identity_id"), F.lit(kind).alias("type"), F.lit(weight).alias("weight"))


def identity_rows(rows: DataFrame, *identities: Column) -> DataFrame:
    """(ord_id, location_id, identity_id, type, weight) of every identity that is present."""
    found = rows.select("ord_id", "location_id", F.inline(F.array(*identities)))
    return found.filter(F.col("identity_id").isNotNull()).distinct()


def hash_weak(identities: DataFrame, salt: str) -> tuple[DataFrame, DataFrame]:
    """Weight-2 combinations are clear text still: hash them, and return their lookup rows.

    Weight-3 identities come hashed from the raw zone.
    """
    weak = F.col("weight") == 2
    hashed = identities.withColumn(
        "identity_id", F.when(weak, fields.salted_hash(F.col("identity_id"), salt)).otherwise(F.col("identity_id"))
    )
    hits = F.struct(
        F.trim("identity_id").alias("original_value"),
        fields.salted_hash(F.col("identity_id"), salt).alias("hashed_value"),
        F.col("type").alias("identity_type"),
    )
    lookup = identities.filter(weak).select(F.inline(F.array(hits))).filter("hashed_value IS NOT NULL").distinct()
    return hashed.filter(F.col("identity_id").isNotNull()).distinct(), lookup


def joined_key(*parts: Column) -> Column:
    """Lower-case parts joined by dashes; null when one is missing."""
    dashed = [p for part in parts for p in (F.lit("-"), F.lower(part))][1:]
    return F.concat(*dashed)


def card_name_key(name: Column) -> Column:
    return joined_key(name, F.col("exp_month"), F.col("exp_year"), F.col("card_brand"), F.col("pan"))


def card_bin_key() -> Column:
    return joined_key(F.col("bin"), F.col("exp_month"), F.col("exp_year"), F.col("card_brand"), F.col("pan"))


def first_last(first: Column, last: Column) -> Column:
    present = (first != "") & (last != "")
    return F.when(present, F.concat(F.trim(F.lower(first)), F.lit("/"), F.trim(F.lower(last))))


def identities_by_order(*sources: DataFrame) -> DataFrame:
    """The sorted list of identities of each order."""
    union = sources[0]
    for more in sources[1:]:
        union = union.unionByName(more)
    named = F.struct(F.col("type").alias("identity_type"), "identity_id")
    return union.filter(F.col("ord_id").isNotNull()).groupBy("ord_id", "location_id").agg(F.array_sort(F.collect_set(named)).alias("identity_ids"))


def hashed_phone(df: DataFrame, name: str, salt: str) -> tuple[DataFrame, DataFrame]:
    return pseudonymise_columns(df, [Rule(name, codes.PHONE)], salt)
