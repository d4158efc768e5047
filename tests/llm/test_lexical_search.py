import math
import random
from collections import Counter

import numpy as np
import pytest

from check_oracle import compare, connect
from tests.llm.hard_rows import documents, plain  # noqa: F401
from tests.llm.test_license_scan import words_of
from tillwork.llm import queries
from tillwork.llm.lexical_search import ImpactIndex, ranked_search


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score), all items' answers one after the other."""
    counts = [Counter(words_of(t or "")) for _, t in docs]
    n = [sum(c.values()) for c in counts]
    n_docs, total = sum(x > 0 for x in n), sum(n)
    df = Counter(w for c in counts for w in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), c, size in zip(docs, counts, n):
            score = 0
            for w in set(words_of(text or "")):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * (10**9 * c[w] // (1000 * c[w] + 8 * (10 + 90 * size * n_docs // total)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(rng, size, words=120):
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = [(d, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60)))) for d in range(size)]
    return docs + [(size + i, t) for i, (_, t) in enumerate(docs[:40])]  # equal texts: ties


@pytest.mark.parametrize("share, query_terms", [(1 << 20, 100_000), (200, 30)])
def test_equals_brute_force(spark, share, query_terms):
    rng = random.Random(2)
    docs = corpus(rng, 400)
    items = [(i, " ".join(rng.choice(docs)[1].split()[:12])) for i in range(25)] + [(90, "unknown words"), (91, None), (92, "")]
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search(*frames, share=share, query_terms=query_terms).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items)


def index_of(rng, docs, terms):
    doc, term = np.nonzero(rng.random((docs, terms)) < rng.random(terms) * 0.6)
    return ImpactIndex(doc, term, rng.integers(1, 1000, len(doc)) // rng.choice([1, 100]) + 1, docs, terms), doc, term


def test_best_positions_stop_early_and_are_right():
    rng = np.random.default_rng(7)
    early = 0
    for _ in range(60):
        docs, terms = int(rng.integers(1, 800)), 12
        index, doc, term = index_of(rng, docs, terms)
        asked = rng.permutation(terms)[: rng.integers(1, 6)]
        weights = rng.integers(1, 50, len(asked))
        score, met, read = index.search(asked, weights, 5)
        full = np.zeros(docs, np.int64)
        for t, w in zip(asked, weights):
            lists = slice(index.start[t], index.start[t + 1])
            np.add.at(full, index.doc[lists], w * index.value[lists])
        assert (score[met] == full[met]).all()
        kth = np.sort(full)[-min(5, docs)]
        assert met[(full >= kth) & (full > 0)].all()  # ties at the k-th included
        early += not met[full > 0].all()
        assert (index._list == -1).all()
    assert early > 10


def test_direct_access_moves_best_positions():
    # the first list's order runs against the second's: what the second read marks the first's end, not its best position
    doc, term = np.repeat(np.arange(100), 2), np.tile([0, 1], 100)
    value = np.where(term == 0, 1000 - doc, 1 + doc)
    index = ImpactIndex(doc, term, value, 100, 2)
    score, met, _ = index.search(np.array([0, 1]), np.array([1, 1]), 3)
    assert met.all() and (score == 1001).all()  # all tie: the bound is strictly below the third score at the end only


def test_hard_rows(spark, documents):
    items = [(1, "the QUICK fox", 1, "x"), (1, "the QUICK fox", 1, "x"), (None, "été id", 2, None), (2, None, 3, "y"), (3, "", 4, "z"), (4, "the " * 5000 + "wolf", 5, "z")]
    frame = spark.createDataFrame(items, "item_id long, text string, rank int, `a.b` string").withColumnRenamed("rank", "score")
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = sorted(map(tuple, ranked_search(documents, frame).collect()), key=repr)
    assert got == brute(docs, [i[:2] for i in items]) and got
    assert ranked_search(documents.limit(0), frame).count() == 0
    assert ranked_search(documents, frame.limit(0)).count() == 0


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op13", queries.QUERIES["op13_lexical_search"], queries.ORACLES["op13_lexical_search"])[0] == "same"
