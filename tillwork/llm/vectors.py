"""What the vector searches share: valid vectors, matrices of Arrow columns, the best k over all blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwork.llm.shared import narrow


def valid_vectors(df: DataFrame, zeros: bool) -> DataFrame:
    """vec_id, dim and the vector as doubles of the rows that take part, one per vec_id.

    Null vectors, those with null or non-finite components and rows without a vec_id do not, nor zero vectors
    unless `zeros`. Of rows of one vec_id the smallest vector takes part (component by component, then the shorter), however the
    rows are dealt out.
    """
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = narrow(df, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(fine)
    if not zeros:
        rows = rows.filter(F.exists("vector", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector")).select("vec_id", F.size("vector").alias("dim"), "vector")


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def blocks(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def in_block(column: str, count: int):
    """A block number from the id alone, the same in every attempt."""
    return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")


def copied(df: DataFrame, name: str, count: int) -> DataFrame:
    """Every row once for each of `count` blocks of the other side."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def best_of_blocks(found: DataFrame, k: int, descending: bool) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of what the blocks found, at most k from each; ties to the smaller vec_id."""
    score = F.col("score").desc() if descending else F.col("score").asc()
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(score, "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def first_k(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k largest scores (all above minus infinity, if fewer); of equals the earlier columns."""
    k = min(k, score.shape[1])
    edge = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k, None]
    row, column = np.nonzero((score >= edge) & (score > -np.inf))
    order = np.lexsort((column, -score[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]
