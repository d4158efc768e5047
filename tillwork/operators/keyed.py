"""Keyed building blocks: one row per key, group totals, spread joins and merges.

None of them gathers a key's rows in one task: they aggregate before the shuffle, join in a way that
lets Spark split a hot key, or split it by a salt that is a function of the row, so a retried
task sees the same split.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FEW_ROWS = 1_000_000  # kept totals up to this number are broadcast


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None, few_copies: bool = False) -> DataFrame:
    """The smallest row of each key (nulls first), by partial aggregation and no window.

    A struct's minimum needs sorted rows: before the shuffle, which reduces a hot key there, and after it.
    With few_copies the rows are shuffled first and sorted once, so all rows of a key go whole into one
    task: only for keys that cannot be hot, not for landing data with replayed records or null keys.
    """
    if few_copies:
        df = df.repartition(*keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order_by = [c for c in (order_by or rest) if c not in keys]
    packed = F.struct(*rest)
    if order_by == rest:
        chosen = F.min(packed)
    else:
        chosen = F.min_by(packed, F.struct(*order_by))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def _row_salt(df: DataFrame, salts: int) -> Column:
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int")


_AGGREGATES = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}


def with_group_totals(
    df: DataFrame, keys: list[str], totals: dict[str, tuple[str, Column]], of: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Attach whole-group min/max/sum/count to every row without a window.

    With `of` the totals are those of that frame: the rows of df before it gained columns by joins, which are then not done again.
    `keep` stores the totals and reads them back: they are counted before the join is planned, and where they are few (at most FEW_ROWS)
    they are broadcast, so that the rows of df are not shuffled.

    The totals are aggregated before the shuffle, so a hot key costs a row per task; they are joined
    back one row per key, and the rows of a hot key on the other side are split by AQE.
    """
    final = (df if of is None else of).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        *[_AGGREGATES[fn](expr).alias(name) for name, (fn, expr) in totals.items()]
    )
    if keep is not None:
        final = keep(final)
        if final.count() <= FEW_ROWS:
            final = F.broadcast(final)
    same = all_of([df[k].eqNullSafe(final[f"_k_{k}"]) for k in keys])
    return df.join(final, same).select(*df.columns, *totals)


def with_group_maximum(df: DataFrame, keys: list[str], name: str, value: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Attach the whole group's largest value of a column (nulls passed over) to every row, by a join with the groups that need one.

    Where all rows of a group agree, as copies of one record do, each has the group's value already. The groups whose rows differ are
    aggregated before the shuffle and stored by `keep`, so their number is known before the join is planned: where they are few, the rows
    of df are neither shuffled nor sorted.
    """
    v, seen = F.col(value), F.count(value)
    groups = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.max(v).alias("_most"), ((F.min(v) < F.max(v)) | ((seen > 0) & (seen < F.count(F.lit(1))))).alias("_differ")
    )
    differing = keep(groups.filter("_differ").drop("_differ"))
    same = all_of([df[k].eqNullSafe(differing[f"_k_{k}"]) for k in keys])
    return df.join(differing, same, "left").select(*df.columns, F.coalesce("_most", value).alias(name))


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], salts: int | None = None) -> DataFrame:
    """Inner join on keys where one key may hold a large share of the big side.

    Spark broadcasts a small side by its size or splits the hot key (AQE). With `salts` the big side
    is split by hand and the small side copied to exactly the salts each key has.
    """
    if not salts:
        return big.join(small, keys)
    salted = big.withColumn("_salt", _row_salt(big, salts))
    pieces = salted.select(*keys, "_salt").distinct()
    return salted.join(small.join(pieces, keys), [*keys, "_salt"]).drop("_salt")


# ---- merges -------------------------------------------------------------------------


def _same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str, nullable: bool) -> Column:
    """Equal keys; null ones are equal too, unless the keys are never null: then a stored partitioning by them serves the join."""
    return all_of([left[k].eqNullSafe(right[prefix + k]) if nullable else left[k] == right[prefix + k] for k in keys])


def _match_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_m_{k}") for k in keys])


def without_matches(df: DataFrame, other: DataFrame, keys: list[str], nullable: bool = True) -> DataFrame:
    """Rows of df whose key (null-safe) is not in other; only other's keys are shuffled."""
    right = _match_keys(other, keys)
    return df.join(right, _same(df, right, keys, "_m_", nullable), "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: a merge source must return none."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def one_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source of a merge, which fails when a key (null-safe) comes twice.

    The count shares the join's shuffle; a key with many rows is what the failure is about.
    """
    counted = source.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    message = F.concat(F.lit("merge source has several rows of the key "), F.to_json(F.struct(*keys)))
    return counted.filter(F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("_copies")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], full: bool = False, nullable: bool = True) -> DataFrame:
    """Matched rows are replaced by the source, other source rows inserted; a key twice in the source fails."""
    if full:
        return source
    return without_matches(target, source, keys, nullable).unionByName(one_row_per_key(source, keys))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str], nullable: bool = True) -> DataFrame:
    """Source rows of new keys are added; a key twice in the source fails."""
    return target.unionByName(without_matches(one_row_per_key(source, keys), target, keys, nullable))


def merge_delete(target: DataFrame, deleted: DataFrame, keys: list[str], nullable: bool = True) -> DataFrame:
    return without_matches(target, deleted, keys, nullable)


def merge_conditional(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: dict[str, Column],
    keep: Column | None = None,
    insert: dict[str, Column] | None = None,
    nullable: bool = True,
) -> DataFrame:
    """Matched rows take the update expressions and are deleted unless keep holds.

    Expressions name target columns plainly and source columns as s_<name>. Unmatched
    source rows are inserted, with the given defaults for columns the source lacks. One
    full outer join reads either side once; a key twice in the source fails.
    """
    ready = one_row_per_key(source, keys)
    fresh = {c: (insert or {}).get(c, F.col(c) if c in source.columns else None) for c in target.columns}
    if lacking := [c for c, value in fresh.items() if value is None]:
        raise ValueError(f"no value to insert for {lacking}")
    prefixed = ready.select(
        *[F.col(c).alias(f"s_{c}") for c in source.columns], *[value.alias(f"_new_{c}") for c, value in fresh.items()], F.lit(True).alias("_hit")
    )
    stored = target.withColumn("_there", F.lit(True))
    both = stored.join(prefixed, _same(stored, prefixed, keys, "s_", nullable), "full_outer")
    there, hit = F.col("_there").isNotNull(), F.col("_hit").isNotNull()
    if keep is not None:
        both = both.filter(~(there & hit) | keep)
    return both.select(
        *[F.when(there & hit, update.get(c, F.col(c))).when(there, F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c) for c in target.columns]
    )


def merge_partial_update(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], nullable: bool = True) -> DataFrame:
    """Matched rows take only the listed columns; unmatched source rows are inserted."""
    return merge_conditional(target, source, keys, {c: F.col(f"s_{c}") for c in columns}, nullable=nullable)


def overwrite_where(target: DataFrame, source: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Replace the rows whose column is one of values by the source's rows of those values."""
    wanted = values.select(F.col(values.columns[0]).alias(column)).distinct()
    kept = without_matches(target, wanted, [column])
    return kept.unionByName(source.join(wanted, column, "left_semi").select(*target.columns))


def full_reload(target: DataFrame, source: DataFrame) -> DataFrame:
    return source.select(*target.columns)
