"""Exact top-k inner products by a Voronoi join.

Queries and data are grouped by their nearest pivot. From the summaries of the data cells (the distances
of the members nearest to the pivot) follows, for a group of queries, a score that each of them
is sure to reach k times; a vector whose greatest possible score with the group is below that is not
sent to it. What is sent is solved locally, block by block, in exact integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.shared import saved
from tillwork.llm.vectors import best_of_blocks, blocks, copied, first_k, in_block, matrix, valid_vectors

DATA_BLOCK, QUERY_BLOCK = 8192, 512
LEAST_PIVOTS, MOST_PIVOTS = 8, 1024  # of each vector length; one for each QUERY_BLOCK queries in between
_SLACK = 1e-9  # relative, for rounding in the bounds


def exact_scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where every sum is exact, else in Python's integers, held within 64 bits."""
    if np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * max(1, queries.shape[1]) < 2**53:
        return queries @ data.T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(queries) @ whole(data).T, -(2**63), 2**63 - 1)


def drawn(rows: DataFrame, dim: int, n: int) -> DataFrame:
    """The n vectors of this length that come first by a hash of vec_id; each task keeps its first n only."""
    return rows.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(n)


def _assign(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x, pivot = matrix(part.column("vector"), dim), pivots[dim]
                cell = ((pivot**2).sum(axis=1) - 2 * x @ pivot.T).argmin(axis=1)
                distance = np.linalg.norm(x - pivot[cell], axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int32()), pa.array(distance)], names=[*part.schema.names, "cell", "distance"])

    return rows.mapInArrow(assign, "vec_id long, dim int, vector array<double>, cell int, distance double")


def sure_scores(pivot: np.ndarray, radius: dict[int, float], near: dict[int, list[float]], k: int) -> dict[int, float]:
    """For each group of queries a score that every member reaches with at least k others.

    With q = p + a and x = r + b, q.x >= p.r - |a||r| - |p||b| - |a||b|; one vector more than k is counted,
    as one may be the query itself. Minus infinity if there are too few vectors.
    """
    out, size = {}, np.linalg.norm(pivot, axis=1)
    for group, reach in radius.items():
        least = [
            pivot[group] @ pivot[cell] - reach * size[cell] - (size[group] + reach) * d for cell, distances in near.items() for d in distances
        ]
        least = sorted(least, reverse=True)
        out[group] = least[k] - _SLACK * (abs(least[k]) + 1) if len(least) > k else -np.inf
    return out


def top_products(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k greatest inner products of the vectors floor(scale * x) with all others.

    vectors: vec_id, embedding; is_query is a condition on vec_id. Exact; ties go to the smaller vec_id; a query
    with fewer than k others gets them all. Vectors are compared with those of their own length; see
    valid_vectors for rows that take no part. Zero vectors do take part. Scores beyond 64 bits are held
    at the limit. An empty table gives no rows.
    """
    whole = F.transform("vector", lambda x: F.rint(F.floor(x * F.lit(scale)).cast("double")))
    rows = valid_vectors(vectors, zeros=True)
    rows = saved(rows.select("vec_id", "dim", F.when(F.size("vector") > 0, whole).otherwise(F.col("vector")).alias("vector")), "integers")
    queries_of = {r["dim"]: r["n"] for r in rows.filter(is_query).groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not queries_of:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    wanted = {dim: min(MOST_PIVOTS, max(LEAST_PIVOTS, blocks(n, query_block))) for dim, n in queries_of.items()}
    rows = rows.filter(F.col("dim").isin(list(queries_of)))
    pivots = {dim: [r["vector"] for r in drawn(rows, dim, n).collect()] for dim, n in wanted.items()}
    pivot = {dim: np.array(v, float).reshape(len(v), dim) for dim, v in pivots.items()}
    placed = saved(_assign(rows, pivot), "cells")

    # summaries: k + 1 distances per cell, one radius per group of queries
    nearest = Window.partitionBy("dim", "cell").orderBy("distance")
    near: dict[int, dict[int, list[float]]] = {}
    for r in placed.select("dim", "cell", "distance").withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1).collect():
        near.setdefault(r["dim"], {}).setdefault(r["cell"], []).append(r["distance"])
    asked = placed.filter(is_query)
    groups: dict[int, dict[int, tuple[float, int]]] = {}
    for r in asked.groupBy("dim", "cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect():
        groups.setdefault(r["dim"], {})[r["cell"]] = (r["radius"], blocks(r["n"], query_block))
    sure = {dim: sure_scores(pivot[dim], {g: radius for g, (radius, _) in of.items()}, near[dim], k) for dim, of in groups.items()}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once for every group (and part of it) that it may matter to."""
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column("vector"), dim)
                length = np.linalg.norm(x, axis=1)
                for group, (radius, parts) in sorted(groups[dim].items()):
                    most = x @ pivot[dim][group] + radius * length
                    kept = part.filter(pa.array(most + _SLACK * (np.abs(most) + 1) >= sure[dim][group]))
                    for number in range(parts):
                        n = len(kept)
                        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.full(n, group, np.int32)), pa.array(np.full(n, number, np.int32))], names=[*kept.schema.names, "group", "part"])

    data_blocks = blocks(placed.count(), data_block)
    sent = placed.select("vec_id", "dim", "vector").mapInArrow(send, "vec_id long, dim int, vector array<double>, group int, part int")
    sent = sent.withColumn("block", in_block("vec_id", data_blocks))
    most_parts = max(parts for of in groups.values() for _, parts in of.values())
    parts_of = F.create_map(*[x for dim, of in groups.items() for g, (_, parts) in of.items() for x in (F.concat_ws(":", F.lit(dim), F.lit(g)), F.lit(parts))])
    part = in_block("query_id", most_parts) if most_parts == 1 else F.pmod(F.xxhash64("query_id"), parts_of[F.concat_ws(":", "dim", "cell")]).cast("int")
    asked = asked.select(F.col("vec_id").alias("query_id"), "dim", F.col("vector").alias("query"), "cell").withColumn("part", part)
    asked = copied(asked.withColumnRenamed("cell", "group"), "block", data_blocks)
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def solve(wanted: pa.Table, held: pa.Table) -> pa.Table:
        if not len(wanted) or not len(held):
            return out.empty_table()
        dim = held["dim"][0].as_py()
        held = held.sort_by("vec_id")
        ids, asking = held["vec_id"].to_numpy(), wanted["query_id"].to_numpy()
        score = exact_scores(matrix(wanted["query"], dim), matrix(held["vector"], dim))
        ranked = score.astype(np.float64) if score.dtype == object else score
        ranked = np.where(asking[:, None] == ids, -np.inf, ranked)
        if score.dtype == object:  # beyond doubles: order by the integers themselves
            pairs = [(i, j) for i in range(len(asking)) for j in sorted(np.flatnonzero(ranked[i] > -np.inf), key=lambda j: (-score[i, j], j))[:k]]
            row, column = np.array(pairs, int).reshape(-1, 2).T
        else:
            row, column = first_k(ranked, k)
        return pa.Table.from_arrays([pa.array(asking[row]), pa.array(ids[column]), pa.array([int(s) for s in score[row, column]], pa.int64())], schema=out)

    keys = ("dim", "group", "part", "block")
    found = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    return best_of_blocks(found, k, descending=True)
