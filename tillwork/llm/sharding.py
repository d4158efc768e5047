"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into ranges of about equal weight, the curve index of a row's cell is
computed, the rows are range-sorted by it and cut into runs of equal count. A run covers a compact
box of the dimensions, so a reader's filter on any of them skips most files.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, running_total, saved

DIMENSIONS = ("source", "lang", "size")
BITS = 5  # cells per dimension: 2**BITS


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer cells (rows x dimensions) below 2**bits.

    Skilling's transform (2004): undo the excess rotations bit by bit, Gray-encode, interleave.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        gray ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= gray
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def range_starts(rows: DataFrame, column: str, bits: int) -> list:
    """The least value of each of at most 2**bits ranges of about equal weight, from counts of all rows.

    A value is never split; the driver gets one value per range.
    """
    counts = saved(rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return []
    cell = F.floor(F.col("before_n") * (1 << bits) / F.lit(total))
    starts = running_total(counts, ["value"], ["n"]).groupBy(cell.alias("cell")).agg(F.min("value").alias("least"))
    return sorted(r["least"] for r in starts.collect())


def _cell(column: Column, starts: list) -> Column:
    """How many range starts are at or below the value; 0 for null."""
    if not starts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= column)) - 1, F.lit(0))


def hilbert_shards(
    docs: DataFrame, shards: int, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in a shard), the curve index and the columns `carry` of every document.

    docs: doc_id, text and the dimensions; size (UTF-8 bytes plus 1; null text: 1) may be a
    dimension. Shard counts differ by one row at most. Nulls of a dimension share its lowest cell;
    rows of one cell follow doc_id (nulls last), size and checksum, so reruns agree. Fewer rows than shards
    leave shards empty; an empty table gives no rows.
    """
    given = [*(c for c in dimensions if c not in ("size", "doc_id")), *carry]
    text = F.col("text")
    rows = saved(
        narrow(docs, "doc_id", "text", *given).select(
            "doc_id",
            *given,
            F.coalesce(F.octet_length(text).cast("long") + 1, F.lit(1).cast("long")).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        ), "rows",
    )

    @F.pandas_udf("long")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(np.int64), bits))

    cells = [_cell(F.col(c), range_starts(rows, c, bits)).cast("int").alias(c) for c in dimensions]
    placed = rows.select("doc_id", "size", "text_crc32", *carry, curve(F.struct(*cells)).alias("curve"), F.lit(1).cast("long").alias("one"))
    ordered = running_total(placed, ["curve", "doc_id", "size", "text_crc32"], ["one"])
    total = rows.count()
    shard = F.expr(f"before_one * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before_one") - first).alias("slot"), "curve", *carry
    )


def write_shards(docs: DataFrame, folder: str, shards: int, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """Write every document once, as one folder per shard (shard=<n>), in curve order; the frame that reads them.

    Rows are told apart by a number of their own, so null and repeated doc_ids lose and multiply nothing. The documents'
    columns keep their names; where one of them is called shard, the shard's is shard_ (or with more underscores).
    """
    taken = {c.lower() for c in docs.columns}
    name = "shard"
    while name in taken:
        name += "_"
    places = [f"column_{i}" for i in range(len(docs.columns))]
    rows = saved(docs.toDF(*places).withColumn("row_number", F.monotonically_increasing_id()), "documents")
    by_name = rows.toDF(*docs.columns, "row_number" if "row_number" not in taken else "row_number_of_shards")
    placed = hilbert_shards(by_name, shards, dimensions, bits, carry=(by_name.columns[-1],))
    where = placed.select(F.col(by_name.columns[-1]).alias("row_number"), F.col("shard").alias("to_shard"), "slot")
    sorted_rows = rows.join(where, "row_number").repartitionByRange("to_shard", "slot").sortWithinPartitions("to_shard", "slot")
    out = sorted_rows.select(*places, "to_shard").toDF(*docs.columns, name)
    out.write.partitionBy(name).parquet(folder)
    return docs.sparkSession.read.parquet(folder)
