import pytest

from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm.mixing import mix, targets


def test_targets_by_rounds(spark):
    sources = [("b", 100), ("a", 10), (None, 1000), ("d", 0), ("c", 50)]
    got = {r["source"]: r["target"] for r in targets(spark.createDataFrame(sources, "source string, source_size long")).collect()}
    names, weight = ["a", "b", "c", "d", None], dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1], strict=True))
    size, budget, full = dict(sources), 1.5 * 1160, {}
    while True:
        rest = [n for n in names if n not in full]
        level = (budget - sum(full.values())) / sum(weight[n] for n in rest)
        over = [n for n in rest if weight[n] * level > 2 * size[n]]
        if not over:
            break
        full |= {n: 2.0 * size[n] for n in over}
    want = {n: full.get(n, weight[n] * level) for n in names}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(budget)


def test_hard_rows(spark, documents):
    rows = plain(mix(documents))
    assert len(rows) == documents.count()
    assert [r["size"] for r in rows if r["doc_id"] in (3, 4)] == [0, 0]
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    assert rows == plain(mix(documents.repartition(3)))
    assert mix(documents.limit(0)).count() == 0


def test_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = plain(mix(docs))
    longest = max(r["size"] for r in rows)
    taken, goal = {}, {}
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    for r in rows:
        s = source[r["doc_id"]]
        taken[s], goal[s] = taken.get(s, 0) + r["taken"], r["target"]
    assert all(abs(taken[s] - goal[s]) <= longest for s in goal)
    total = sum(r["size"] for r in rows)
    assert 1.5 * total - longest <= sum(taken.values()) <= 1.5 * total
