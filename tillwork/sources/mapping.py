"""Column mapping shared by imports and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.keyed import first_per_key, merge_upsert


def map_columns(df: DataFrame, mapping: list[dict], include_all: bool) -> DataFrame:
    """Rename and optionally cast: entries {source, dest, cast?}; other columns kept on demand."""
    rules = {m["source"]: m for m in mapping}
    columns = df.columns if include_all else list(rules)

    def mapped(name: str):
        rule = rules.get(name)
        if rule is None:
            return F.col(f"`{name}`")
        value = F.col(f"`{name}`")
        return (value.try_cast(rule["cast"]) if rule.get("cast") else value).alias(rule["dest"])

    return df.select(*[mapped(c) for c in columns])


def underscore_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns})


def import_documents(
    stored: DataFrame, documents: DataFrame, mapping: list[dict], include_all: bool, feed_date: str, keys: list[str],
    dedupe: bool = True,
) -> DataFrame:
    """A document collection snapshot upserted into its keyed table."""
    rows = map_columns(documents, mapping, include_all).withColumn("feed_date", F.lit(feed_date).cast("date"))
    if dedupe:
        rows = first_per_key(rows, keys)
    return merge_upsert(stored, rows.select(*stored.columns), keys)
