"""Saved tables, global running totals and stable hashes that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """The frame written as Parquet in the shared folder and read again: lineage ends here."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Delete the files of a saved table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, each by its exact name, whatever other columns there are.

    Works with names that hold dots and with others that differ in case only; of equal names the first counts.
    """
    at = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    if lacking := [n for n in names if n not in at]:
        raise ValueError(f"no column {', '.join(lacking)}")
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_place.select(*[F.col(f"c{at[n]}").alias(n) for n in names])


def plain_names(df: DataFrame, *names: str) -> DataFrame:
    """All columns in place, these under their names and the others as column_<place>; toDF gives the names back."""
    first = {name: df.columns.index(name) for name in names}
    return df.toDF(*[c if first.get(c) == i else f"column_{i}" for i, c in enumerate(df.columns)])


def running_total(df: DataFrame, order: list[str], amounts: list[str]) -> DataFrame:
    """Adds before_<a> and pid: the sum of each amount over all rows before this one in a global order.

    The rows are range-sorted; each task writes its own running sums, the driver gets one row
    per partition (their totals) and adds the offsets. The order columns must tell all but
    interchangeable rows apart, so that no key, however hot, is stuck in one partition.
    """
    spark = df.sparkSession
    extra = [T.StructField(f"before_{a}", T.LongType()) for a in amounts] + [T.StructField("pid", T.IntegerType())]
    schema = T.StructType([*df.schema.fields, *extra])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pid = dict.fromkeys(amounts, 0), TaskContext.get().partitionId()
        for batch in batches:
            added = []
            for a in amounts:
                size = batch.column(a).to_numpy(zero_copy_only=False).astype(np.int64)
                until = np.cumsum(size)
                added.append(pa.array(total[a] + until - size, pa.int64()))
                total[a] += int(until[-1]) if len(until) else 0
            added.append(pa.array(np.full(batch.num_rows, pid, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[f.name for f in schema.fields])

    ranged = df.repartitionByRange(partitions(spark), *[F.col(c).asc_nulls_last() for c in order])
    local = saved(ranged.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order]).mapInArrow(sums, schema), "ordered")
    totals = sorted(tuple(r) for r in local.groupBy("pid").agg(*[F.sum(a) for a in amounts]).collect())
    if not totals:
        return local
    starts, base = dict.fromkeys(amounts, 0), {a: [0] * (totals[-1][0] + 1) for a in amounts}
    for pid, *sizes in totals:
        for a, size in zip(amounts, sizes, strict=True):
            base[a][pid] = starts[a]
            starts[a] += size
    return local.withColumns({f"before_{a}": F.col(f"before_{a}") + by_place(spark, base[a], F.col("pid")) for a in amounts})


def running_by_key(df: DataFrame, key: str, order: list[str], amounts: list[str], xors: tuple[str, ...] = ()) -> DataFrame:
    """Adds until_<a>: the sum (for xors the exclusive or) of the key's values up to and with this row.

    The rows are range-sorted by key (a long, not null) and order, so a key's rows may lie in many tasks: each task
    runs its own sums, and the driver gets a row per partition, from which it carries what a key that goes
    on in the next partition has so far. The result is a saved table.
    """
    spark, names = df.sparkSession, [*amounts, *xors]
    extra = [T.StructField(f"until_{a}", T.LongType()) for a in names]
    extra += [T.StructField("pid", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("head", T.BooleanType())]
    schema = T.StructType([*df.schema.fields, *extra])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, place, first, last, carry = TaskContext.get().partitionId(), 0, None, None, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy()
            new = np.ones(n, bool)
            new[1:] = keys[1:] != keys[:-1]
            start, run = np.flatnonzero(new), np.cumsum(new) - 1
            added = []
            for a in names:
                value = batch.column(a).to_numpy().astype(np.int64)
                add = np.bitwise_xor if a in xors else np.add
                until = add.accumulate(value)
                before = until[start] ^ value[start] if a in xors else until[start] - value[start]
                until = until ^ before[run] if a in xors else until - before[run]
                if last is not None and keys[0] == last:
                    until[run == 0] = add(until[run == 0], carry[a])
                carry[a] = until[-1]
                added.append(pa.array(until))
            first, last = keys[0] if first is None else first, keys[-1]
            added += [pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(place, place + n)), pa.array(keys == first)]
            place += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[f.name for f in schema.fields])

    ranged = df.repartitionByRange(partitions(spark), key, *order).sortWithinPartitions(key, *order)
    local = saved(ranged.mapInArrow(sums, schema), "running")
    ends = local.groupBy("pid").agg(F.min(key), F.max(key), *[F.max_by(f"until_{a}", "place") for a in names]).collect()
    offsets = {a: [0] * (max((r[0] for r in ends), default=0) + 1) for a in names}
    open_key, carry = None, dict.fromkeys(names, 0)
    for pid, first, last, *until in sorted(tuple(r) for r in ends):
        for a, value in zip(names, until, strict=True):
            offsets[a][pid] = carry[a] if first == open_key else 0
            if first == last:
                value = value ^ offsets[a][pid] if a in xors else value + offsets[a][pid]
            carry[a] = value
        open_key = last

    def whole(a: str) -> Column:
        so_far, rest = F.col(f"until_{a}"), by_place(spark, offsets[a], F.col("pid"))
        return F.when(F.col("head"), so_far.bitwiseXOR(rest) if a in xors else so_far + rest).otherwise(so_far)

    return local.withColumns({f"until_{a}": whole(a) for a in names}).drop("pid", "place", "head")


def by_place(spark: SparkSession, values: list[int], place: Column) -> Column:
    """The value at a place of a list, which is one literal: a row costs one step, however long the list is."""
    return F.get(F.lit(np.array(values, np.int64)), place)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
