"""Pseudonymise personal fields and keep the (original, hashed, type) lookup."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import fields
from tillwork.functions.json_index import json_places
from tillwork.operators.keyed import first_per_key, merge_insert_only, merge_upsert

NORMALISERS: dict[str, Callable[[Column], Column]] = {
    "email": fields.email,
    "phone": fields.phone,
    "advertiser_id": fields.advertiser_id,
}


@dataclass(frozen=True)
class Rule:
    """What to hash: a column, or a path of names and '*' inside a JSON column."""

    column: str
    identity_type: str | None = None
    normaliser: str | None = None
    path: tuple[str, ...] = ()

    def clean(self, value: Column) -> Column:
        normal = NORMALISERS[self.normaliser](value) if self.normaliser else value
        return fields.blank_to_null(normal)


def _hit(original: Column, salt: str, identity_type: str | None) -> Column:
    return F.struct(
        original.alias("original_value"),
        fields.salted_hash(original, salt).alias("hashed_value"),
        F.lit(identity_type).cast("string").alias("identity_type"),
    )


def pseudonymise_columns(df: DataFrame, rules: list[Rule], salt: str) -> tuple[DataFrame, DataFrame]:
    """Hashed table and lookup rows; each PII value is un-pivoted in one pass."""
    clean = {r.column: r.clean(F.col(r.column).cast("string")) for r in rules}
    hashed = df.withColumns({name: fields.salted_hash(value, salt) for name, value in clean.items()})
    hits = F.array(*[_hit(clean[r.column], salt, r.identity_type) for r in rules])
    lookup = df.select(F.inline(hits)).filter(F.col("original_value").isNotNull())
    return hashed, lookup


def pseudonymise_json(df: DataFrame, rules: list[Rule], salt: str) -> tuple[DataFrame, DataFrame]:
    """The same for values at paths inside JSON columns of any shape.

    Only the text of the values at the paths changes; every other character stays, so numbers, nulls,
    repeated names and blanks are what they were. A value that normalises to nothing becomes null
    and gets no lookup row; null stays null. A malformed document fails the job. One Arrow step finds the
    places of the values, all else is column expressions.
    """
    columns = list(dict.fromkeys(r.column for r in rules))
    if len({(r.column, r.path) for r in rules}) < len(rules):
        raise ValueError("two rules have the same path")
    found = {}
    for c in columns:
        mine = [r for r in rules if r.column == c]
        found[c] = F.transform(_places([r.path for r in mine])(F.col(c)), _judge(mine, salt))
    # one row per document again: the explode keeps the optimizer from copying the parse into every use
    parsed = df.select("*", F.explode(F.array(F.struct(*[v.alias(c) for c, v in found.items()]))).alias("_found"))
    hashed = parsed.withColumns({c: _spliced(F.col(c), F.col("_found")[c]) for c in columns}).drop("_found")
    hits = F.flatten(F.array_compact(F.array(*[F.col("_found")[c] for c in columns])))
    lookup = parsed.select(F.inline(hits)).filter(F.col("original_value").isNotNull())
    return hashed, lookup.select("original_value", "hashed_value", "identity_type")


def _judge(rules: list[Rule], salt: str) -> Callable[[Column], Column]:
    types = F.array(*[F.lit(r.identity_type).cast("string") for r in rules])

    def judged(hit: Column) -> Column:
        value = F.lit(None).cast("string")
        for i, rule in enumerate(rules):
            value = F.when(hit["rule"] == i, rule.clean(hit["value"])).otherwise(value)
        return F.struct(
            value.alias("original_value"), fields.salted_hash(value, salt).alias("hashed_value"), F.get(types, hit["rule"]).alias("identity_type"),
            hit["start"].alias("start"), hit["stop"].alias("stop"),
        )

    return judged


def _spliced(text: Column, hits: Column) -> Column:
    """The text with the hash, quoted, or null in the place of every hit; hits are in the order of the text."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def add(state: Column, hit: Column) -> Column:
        between = F.substring(text, state["at"] + 1, hit["start"] - state["at"])
        new = F.coalesce(F.concat(F.lit('"'), hit["hashed_value"], F.lit('"')), F.lit("null"))
        return F.struct(F.concat(state["done"], between, new).alias("done"), hit["stop"].alias("at"))

    return F.aggregate(hits, start, add, lambda state: F.concat(state["done"], F.substring(text, state["at"] + 1, F.length(text))))


def _places(paths: list[tuple[str, ...]]):
    @F.arrow_udf("array<struct<rule:int,value:string,start:int,stop:int>>")
    def places(texts: pa.Array) -> pa.Array:
        return json_places(texts, paths)

    return places


def privacy_lookup_upsert(table: DataFrame, lookup: DataFrame, source: str, feed_date: str, run_id: str) -> DataFrame:
    """Stamp lookup rows with their origin and upsert them."""
    rows = first_per_key(lookup, ["hashed_value", "identity_type"]).select(
        "original_value", "hashed_value", "identity_type",
        F.lit(feed_date).cast("date").alias("feed_date"), F.lit(run_id).alias("run_id"), F.lit(source).alias("source_id"),
    )
    return merge_upsert(
        table, rows.select(*table.columns), ["feed_date", "run_id", "source_id", "identity_type", "hashed_value"]
    )


def privacy_lookup_dedup(final: DataFrame, intermediate: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert into the final lookup what the changed (feed_date, run_id) pairs bring anew."""
    pairs = changes.select("feed_date", "run_id").dropna().distinct()
    rows = intermediate.join(pairs, ["feed_date", "run_id"], "left_semi").select(*final.columns)
    key = ["source_id", "identity_type", "hashed_value"]
    return merge_insert_only(final, first_per_key(rows, key), key)


def with_identity_metadata(identities: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct (identity_id, type, weight) with metadata taken from the original value."""
    once = first_per_key(identities.select("identity_id", "type", "weight"), ["identity_id", "type"])
    originals = first_per_key(
        lookup.select(F.col("hashed_value").alias("identity_id"), F.col("identity_type").alias("type"), "original_value"),
        ["identity_id", "type"],
    )
    return once.join(originals, ["identity_id", "type"], "left").select(
        "identity_id", "type", "weight",
        fields.identity_metadata(F.col("type"), F.col("original_value")).alias("metadata"),
    )
