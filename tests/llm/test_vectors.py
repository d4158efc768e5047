import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import compare, connect
from tests.llm.hard_rows import plain
from tillwork.llm import queries
from tillwork.llm.bit_codes import bounds, encode, nearest, rotation
from tillwork.llm.vectors import first_k, valid_vectors
from tillwork.llm.voronoi import drawn, exact_scores, sure_scores, top_products

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, vector string"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA).repartition(3)


def hard_rows(rng):
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (200, rows[3][1]), (200, rows[3][1])]  # ties, a repeated row
    rows += [(300, [0.0] * 6), (301, None), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (400, [NAN] * 6), (401, [INF] * 6), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (None, rows[0][1]), (600, [])]
    return rows


def brute(rows, zeros, score, best, k):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zeros or any(v)):
            seen[i] = np.array(v, float)
    out = []
    for q in (i for i in seen if i % 100 == 0):
        found = sorted((best * score(seen[q], x), i) for i, x in seen.items() if i != q and len(x) == len(seen[q]))
        out += [(q, r, i, best * s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 512), (9, 2)])
def test_top_products_equal_brute_force(spark, blocks):
    rows = hard_rows(np.random.default_rng(3))
    got = top_products(frame(spark, rows), F.col("vec_id") % 100 == 0, data_block=blocks[0], query_block=blocks[1])
    want = brute(rows, True, lambda a, b: int(np.floor(1024 * a) @ np.floor(1024 * b)), -1, 10)
    assert sorted(map(tuple, got.collect())) == want


def test_clustered_vectors_prune_and_stay_exact(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8)) * 20
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(size=8) * 0.01]) for i in range(1200)]
    got = top_products(frame(spark, rows), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, True, lambda a, b: int(np.floor(1024 * a) @ np.floor(1024 * b)), -1, 10)
    pivot = np.array([[10.0, 0], [-10.0, 0]])
    sure = sure_scores(pivot, {0: 1.0}, {0: [0.0, 0.5, 1.0], 1: [0.0]}, 2)
    assert 75 < sure[0] <= 10 * 10 - 10 - 11 and 100 > sure[0] > pivot[0] @ pivot[1] + 20  # the other cell can be left out


def test_pivots_are_drawn_without_one_sort_of_the_table(spark):
    rows = spark.range(3000).select(F.col("id").alias("vec_id"), (F.col("id") % 2).cast("int").alias("dim"), F.array(F.col("id").cast("double")).alias("vector"))
    pivots = drawn(rows, 1, 1024)
    plan = pivots._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan and "Exchange" not in plan
    want = sorted((r["h"], r["vec_id"]) for r in rows.filter("dim = 1").select("vec_id", F.xxhash64("vec_id").alias("h")).collect())[:1024]
    assert [r["vec_id"] for r in pivots.collect()] == [v for _, v in want]


def test_scores_beyond_doubles():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**30, 3.0]])
    assert exact_scores(a, b)[0].tolist() == [2**60 + 1, 2**63 - 1]


def test_first_k_keeps_the_earlier_of_equals():
    row, column = first_k(np.array([[1.0, 5, 5, 5, -np.inf], [-np.inf, 0, 0, 0, 0]]), 2)
    assert row.tolist() == [0, 0, 1, 1] and column.tolist() == [1, 2, 1, 2]


@pytest.mark.parametrize("blocks", [(8192, 512), (9, 2)])
def test_nearest_on_hard_rows(spark, blocks):
    rows = hard_rows(np.random.default_rng(4))
    got = nearest(frame(spark, rows), F.col("vec_id") % 100 == 0, epsilon=100, data_block=blocks[0], query_block=blocks[1])
    want = brute(rows, False, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), 1, 10)
    assert [r[:3] for r in sorted(map(tuple, got.collect()))] == [r[:3] for r in want]  # with an error bound that wide all is compared
    assert [r[3] for r in sorted(map(tuple, got.collect()))] == pytest.approx([r[3] for r in want], abs=1e-12)


def test_recall_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in nearest(docs, F.col("vec_id") % 100 == 0).collect()}
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect()]
    want = brute(rows, False, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), 1, 10)
    hits = [(q, i) in got for q, _, i, _ in want]
    assert np.mean(hits) >= 0.99
    assert all(got[q, i] == pytest.approx(s, abs=1e-12) for q, _, i, s in want if (q, i) in got)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    centre = x.mean(axis=0)
    codes, length, correction = encode(x, centre)
    far = np.linalg.norm(q - centre, axis=1)
    low, high = bounds(codes, length, correction, (q - centre) @ rotation(64) / far[:, None], far, 2.5)
    true = ((q[:, None] - x) ** 2).sum(axis=2)
    assert ((low <= true) & (true <= high)).mean() > 0.98 and codes.shape == (500, 8)
    assert np.allclose(rotation(64) @ rotation(64).T, np.eye(64))


def test_empty(spark):
    none = frame(spark, [(1, [1.0])]).limit(0)
    assert nearest(none, F.col("vec_id") % 100 == 0).count() == 0 == top_products(none, F.col("vec_id") % 100 == 0).count()
    assert plain(top_products(frame(spark, [(0, [1.0]), (1, [2.0])]), F.col("vec_id") % 100 == 0)) == [{"query_id": 0, "rank": 1, "vec_id": 1, "score": 1024 * 2048}]


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op5", queries.QUERIES["op5_voronoi_top_products"], queries.ORACLES["op5_voronoi_top_products"])[0] == "same"


def test_two_vectors_of_one_id_give_the_same_answer_however_they_are_dealt_out(spark):
    rows = [(5, [9.0, 9.0]), (5, [0.5, 1.0]), (0, [1.0, 1.0]), (100, [1.0, 0.25]), (100, [1.0, 3.0]), (7, [2.0, 2.0, 2.0]), (7, [2.0, 2.0])]
    seen = set()
    for parts in (1, 2, 5):
        for ordered in (rows, rows[::-1]):
            frame = spark.createDataFrame(ordered, "vec_id long, embedding array<double>").repartition(parts)
            seen.add(str([plain(f(frame, F.col("vec_id") % 100 == 0)) for f in (nearest, top_products)]))
    assert len(seen) == 1
    found = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {(r["vec_id"], tuple(r["vector"])) for r in valid_vectors(found, False).collect()} == {(5, (0.5, 1.0)), (0, (1.0, 1.0)), (100, (1.0, 0.25)), (7, (2.0, 2.0))}
