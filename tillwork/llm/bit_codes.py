"""Approximate nearest neighbours with randomly rotated one-bit codes.

A vector's residual from the centre is rotated and only the signs are kept, packed, with its
length and one correction scalar. A query's inner product with every code, divided by the
correction, estimates that with the vector; a bound on the error tells which vectors may be among the
nearest, and only those are compared in full. The bound holds for each pair with high
probability, set by EPSILON.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import saved
from tillwork.llm.vectors import best_of_blocks, blocks, copied, in_block, matrix, valid_vectors

EPSILON = 2.5  # half width of the error bound in units of its standard deviation
DATA_BLOCK, QUERY_BLOCK = 8192, 512
SEED = 20240301


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length of the residual, and the inner product of the code with the residual's direction."""
    residual = vectors - centre
    length = np.linalg.norm(residual, axis=1)
    turned = residual @ rotation(len(centre)) / np.where(length > 0, length, 1)[:, None]
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(len(centre))


def bounds(codes: np.ndarray, length: np.ndarray, correction: np.ndarray, query: np.ndarray, query_length: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances, queries x vectors; query: rotated directions."""
    dim = query.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    safe = np.maximum(correction, 1e-9)
    cosine = (query.astype(np.float32) @ signs.T) / (np.sqrt(dim) * safe)
    error = epsilon * np.sqrt(np.maximum(1 - safe**2, 0) / max(dim - 1, 1)) / safe + 1e-5
    sides = query_length[:, None] ** 2 + length**2
    scale = 2 * query_length[:, None] * length
    return sides - scale * (cosine + error), sides - scale * (cosine - error)


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean of all vectors of each length; tasks return one sum per length."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                mine = matrix(batch.column("vector").filter(pa.array(dims == dim)), dim)
                total[dim] = total.get(dim, np.zeros(dim + 1)) + np.append(mine.sum(axis=0), len(mine))
        listed = [(d, i, v) for d, vector in total.items() for i, v in enumerate(vector.tolist())]
        columns = list(zip(*listed, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())], names=["dim", "place", "value"])

    out: dict[int, dict[int, float]] = {}
    for dim, place, value in rows.select("dim", "vector").mapInArrow(sums, "dim int, place int, value double").groupBy("dim", "place").agg(F.sum("value")).collect():
        out.setdefault(dim, {})[place] = value
    return {dim: np.array([v[i] for i in range(dim)]) / v[dim] for dim, v in out.items()}


def build_index(rows: DataFrame, middle: dict[int, np.ndarray]) -> DataFrame:
    """Every valid vector with its code, residual length and correction."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                codes, length, correction = encode(matrix(part.column("vector"), dim), middle[dim])
                packed = [c.tobytes() for c in codes]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(packed, pa.binary()), pa.array(length), pa.array(correction)], names=[*part.schema.names, "code", "length", "correction"])

    return rows.mapInArrow(code, "vec_id long, dim int, vector array<double>, code binary, length double, correction double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, epsilon: float = EPSILON, data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest other vectors found, score the exact Euclidean distance.

    vectors: vec_id, embedding; is_query is a condition on vec_id. All vectors are indexed and
    scanned, in blocks of the data against blocks of the queries; a block returns its k best after exact reranking.
    Vectors are compared with those of their own length. See valid_vectors for rows that take no part. Ties go to
    the smaller vec_id; a query with fewer than k others gets them all; an empty table gives no rows.
    """
    rows = valid_vectors(vectors, zeros=False)
    middle = centres(rows)
    index = saved(build_index(rows, middle), "codes")
    queries = index.filter(is_query).select(F.col("vec_id").alias("query_id"), "dim", F.col("vector").alias("query"))
    data_blocks, query_blocks = blocks(index.count(), data_block), blocks(queries.count(), query_block)
    data = copied(index.withColumn("block", in_block("vec_id", data_blocks)), "query_block", query_blocks)
    asked = copied(queries.withColumn("query_block", in_block("query_id", query_blocks)), "block", data_blocks)
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(wanted: pa.Table, held: pa.Table) -> pa.Table:
        if not len(wanted) or not len(held):
            return out.empty_table()
        dim = held["dim"][0].as_py()
        held = held.sort_by("vec_id")
        query, x, ids = matrix(wanted["query"], dim), matrix(held["vector"], dim), held["vec_id"].to_numpy()
        asking = wanted["query_id"].to_numpy()
        residual = query - middle[dim]
        far = np.linalg.norm(residual, axis=1)
        turned = residual @ rotation(dim) / np.where(far > 0, far, 1)[:, None]
        codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(held), -1)
        low, high = bounds(codes, held["length"].to_numpy(), held["correction"].to_numpy(), turned, far, epsilon)
        own = asking[:, None] == ids
        low[own] = high[own] = np.inf
        most = min(k, len(ids)) - 1
        edge = np.partition(high, most, axis=1)[:, most, None]
        found = []
        for i in range(len(query)):  # exact distances of the vectors whose lower bound is within the k-th upper bound
            near = np.flatnonzero((low[i] <= edge[i]) & ~own[i])
            distance = np.sqrt(((x[near] - query[i]) ** 2).sum(axis=1))
            order = np.lexsort((ids[near], distance))[:k]
            found.append((np.full(len(order), asking[i]), ids[near[order]], distance[order]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=out)

    keys = ("dim", "block", "query_block")
    found = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    return best_of_blocks(found, k, descending=False)
