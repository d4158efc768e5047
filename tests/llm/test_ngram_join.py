import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracle import compare, connect
from tests.llm.hard_rows import documents, plain  # noqa: F401
from tests.llm.test_license_scan import words_of
from tillwork.llm import ngram_join, queries
from tillwork.llm.ngram_join import near_duplicates, plan_bands
from tillwork.llm.words import find_words, shingle_hashes, word_hashes


def grams(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = {d: grams(t) for d, t in docs}
    ids = list(sets)
    near = {a: {b for b in ids if b != a and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8} for a in ids}
    out = {}
    for a in ids:
        reach, todo = {a}, [a]
        while todo:
            todo += (fresh := near[todo.pop()] - reach)
            reach |= fresh
        out[a] = (min(reach), len(near[a]))
    return out


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("abcdefgh") * 3
    return " ".join(words)


@pytest.mark.parametrize("block", [256, 7])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # 7: groups of many blocks
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    docs = []
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randrange(60, 200))
        docs += [edited(rng, words, rng.randrange(0, 5)) for _ in range(rng.choice([1, 2, 5, 40]))]
    docs = list(enumerate(docs + docs[:9] + ["one two", "One  two!", "one", "", "  "]))
    rng.shuffle(docs)
    want = brute(docs)
    rows = plain(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in rows} == want and len(rows) == len(docs)


def test_empty_blocks_add_no_links(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 900)  # about a text: as many blocks as nodes, some empty
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    docs = []
    for size in (2, 2, 2, 3, 3, 5):
        words = rng.choices(vocabulary, k=150)
        docs += [edited(rng, words, 1) for _ in range(size)]
    docs = list(enumerate(docs + docs[:2]))
    rows = plain(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in rows} == brute(docs)


def test_a_block_pair_with_one_block_empty_is_skipped():
    text = " ".join(f"w{i}" for i in range(50))
    rows = {"node": [1, 2], "copies": [1, 1], "text": [text, text + " more"], "block": [0, 0]}
    for two, links in ((0, [1, 1]), (1, [])):
        table = pa.table(rows | {"one": [0, 0], "two": [two, two]})
        assert ngram_join._verify(5, 0.8)(table)["links"].to_pylist() == links


def test_hard_rows(spark, documents):
    rows = plain(near_duplicates(documents))
    got = sorted(((r["doc_id"], r["class_id"], r["links"]) for r in rows), key=str)
    # the very long text repeats the others' words, so its set of n-grams is the same
    assert got == sorted([(1, 1, 3), (1, 1, 3), (2, 1, 3), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 1, 3), (7, 7, 0), (None, None, 0), (None, None, 0)], key=str)
    assert near_duplicates(documents.limit(0)).count() == 0


def test_texts_of_one_doc_id_have_classes_of_their_own(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (2, b + " z"), (3, a + " z"), (0, a + " y")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"], r["links"]) for r in near_duplicates(docs).collect())
    assert got == [(0, 0, 2), (1, 0, 2), (1, 1, 1), (2, 1, 1), (3, 0, 2)]


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = plan_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= ngram_join.MAX_HASHES
    with pytest.raises(ValueError):
        plan_bands(0.1, 0.999999, 10)


def test_recall_of_the_bands_at_the_threshold(spark):
    rng = random.Random(9)
    pairs = []
    for i in range(400):  # 6 changed words in 250 leave a similarity of about 0.79 to 0.81
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(250)]
        pairs += [(2 * i, " ".join(words)), (2 * i + 1, edited(rng, words, 6))]
    texts = dict(pairs)
    near = [i for i in range(0, 800, 2) if len(grams(texts[i]) & grams(texts[i + 1])) / len(grams(texts[i]) | grams(texts[i + 1])) >= 0.8]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert len(near) > 30 and all(got[i + 1] == i for i in near)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1é \n\U0001f600-", max_size=30), max_size=6))
def test_words_and_shingles(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    words = find_words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    hashes = word_hashes(words)
    listed = [[words.text(j).decode() for j in range(words.first[i], words.first[i + 1])] for i in range(len(texts))]
    assert listed == [words_of(t) for t in texts]
    spelled = {}
    for w, h in zip([w for ws in listed for w in ws], hashes, strict=True):
        assert spelled.setdefault(w, h) == h
    assert len(set(spelled.values())) == len(spelled)
    shingles, first = shingle_hashes(hashes, words.first, 5)
    for i, t in enumerate(texts):
        assert len(set(shingles[first[i] : first[i + 1]])) == len(grams(t))


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op2", queries.QUERIES["op2_ngram_join"], queries.ORACLES["op2_ngram_join"])[0] == "same"
