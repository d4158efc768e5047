import zlib

import numpy as np
import pytest

from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm import language_id as lid


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return lid.learn(docs)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    model = lid._new_model(["a", "b", "c"], 3, rng)
    for k in ("read", "turn", "bias", "out", "base"):
        setattr(model, k, getattr(model, k).astype(np.float64))
    text, weight, label = rng.integers(97, 103, (4, 7)).astype(np.uint8), rng.random((4, 7)), np.array([0, 1, 2, 1])
    _, grads = lid.gradients(model, text, weight, label)
    for k, g in grads.items():
        value = getattr(model, k)
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape)
            if k == "read":
                at = (at[0], int(rng.integers(97, 103)), at[2])
            kept, step = value[at], 1e-5
            value[at] = kept + step
            up = lid.gradients(model, text, weight, label)[0]
            value[at] = kept - step
            down = lid.gradients(model, text, weight, label)[0]
            value[at] = kept
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-8)


def test_reading_equals_the_trained_network():
    """The fast pass over runs gives the same chances as the forward pass used in training."""
    rng = np.random.default_rng(3)
    model = lid._new_model(["a", "b"], 4, rng)
    runs = rng.integers(97, 120, (5, 9)).astype(np.uint8)
    got = np.zeros((9, 2, 5))
    for t, chance in lid.run_chances(model, runs):
        got[t] = chance
    label = np.zeros(5, int)
    for t in range(9):  # the loss with all weight on one position tells its chance
        weight = np.zeros((5, 9))
        weight[:, t] = 1
        loss, _ = lid.gradients(model, runs, weight, label)
        assert loss == pytest.approx(-np.log(got[t, 0]).mean(), rel=1e-4)


def test_held_out_accuracy(docs, model):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    right = []
    for r in lid.identify(docs, model).collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["lang_pred"] != "und":
            right.append(truth[r["doc_id"]][0] == r["lang_pred"])
    assert len(right) > 150 and np.mean(right) >= 0.95


def test_hard_rows(spark, documents, model):
    rows = plain(lid.identify(documents, model))
    assert len(rows) == documents.count()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"]}
    assert by[3] == by[4] == ("und", 0.0) and by[1][0] == by[6][0] == "en" and all(0 <= s <= 1 for _, s in by.values())
    texts = ["123 !? 😀", "日本", "é", "x", "\n"]
    got = plain(lid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model))
    assert [r["lang_pred"] == "und" for r in got] == [True, False, False, False, True]
    assert lid.identify(documents.limit(0), model).count() == 0


def test_without_labels(spark, documents):
    from pyspark.sql import functions as F

    assert lid.learn(documents.limit(0)) is None and lid.learn(documents.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in lid.identify(documents, None).collect()} == {"und"}


def test_lang_source_and_doc_id_are_no_inputs(spark, docs, model):
    from pyspark.sql import functions as F

    some = docs.limit(50)
    other = some.withColumns({"lang": F.lit("zz"), "source": F.lit("s"), "doc_id": F.col("doc_id") + 10_000})
    a, b = lid.identify(some, model).collect(), lid.identify(other, model).collect()
    assert {(r["doc_id"] + 10_000, r["lang_pred"], r["score"]) for r in a} == {tuple(r) for r in b}


def test_long_texts_do_not_depend_on_their_neighbours(model):
    raw = [b"the of and thing " * 900, "été les dans ".encode() * 700, b"", b"der und"]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = lid.document_chances(model, np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, r in enumerate(raw):
        alone = lid.document_chances(model, np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert np.allclose(together[i], alone[0], atol=1e-4)
    marked = lid.label_positions(model, "the of and thing " * 30)
    assert marked[0][0] == 0 and marked[-1][1] == 510 and all(a[1] == b[0] for a, b in zip(marked, marked[1:], strict=False))
