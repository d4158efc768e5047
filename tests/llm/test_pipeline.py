from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm import language_id, mixing, ngram_join, packing
from tillwork.llm.tokens import default_vocabulary


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(10_000, None, "en", "src0", 0), (10_001, "12 34 !!", "en", "src0", 8), (10_002, docs.first()["text"], "en", "zz", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    seen = docs
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, "/root/testdata/sf0.001")
        out.write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
        outs.append(seen)
    identified, unique, mixed, packed = outs
    assert identified.columns == unique.columns == mixed.columns == docs.columns
    ids = {r["doc_id"] for r in identified.collect()}
    assert ids == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")} and 10_002 in ids  # clean documents stay
    classes = {r["class_id"] for r in ngram_join.near_duplicates(identified).collect()}
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(classes) and 10_002 not in classes
    times = {r["doc_id"]: r["copies"] for r in mixing.mix(unique).collect()}
    got = [r["doc_id"] for r in mixed.collect()]
    assert {d: got.count(d) for d in times} == times
    assert packed.count() == packing.pack_documents(mixed, default_vocabulary()).count() and packed.agg({"length": "max"}).first()[0] <= 4096


def test_hard_rows(spark, documents, tmp_path):
    seen = documents
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, seen, "")
        assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
    assert seen.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), "").count() == 0
    unique = corpus_pipeline.drop_near_duplicates(spark, documents, "")
    assert sorted(str(r["doc_id"]) for r in unique.collect()) == ["1", "3", "4", "5", "7", "None", "None"]


def test_every_text_is_compared_whatever_its_doc_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, b), (3, a + " z"), (None, c), (None, c + " z"), (None, a), (5, "!"), (5, "!"), (5, "?"), (None, "!"), (None, "!"), (7, "Ä"), (8, "ä")]
    unique = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    got = [(r["doc_id"], r["text"]) for r in unique.collect()]
    of_c = [x for x in got if x[0] is None and x[1].startswith("c0")]
    assert len(of_c) == 1
    want = [(1, a), (1, b), (5, "!"), (5, "?"), (None, "!"), (None, "!"), (7, "Ä"), (8, "ä")]
    assert sorted(map(str, got)) == sorted(map(str, want + of_c))


def test_repeated_rows_mix_as_often_as_they_are_taken(spark, documents):
    out = plain(corpus_pipeline.mix_sources(spark, documents, ""))
    taken = mixing.mix(documents).agg({"copies": "sum"}).first()[0]
    assert len(out) == taken


def test_map_columns_are_mixed_like_others(spark, documents):
    plain_rows = corpus_pipeline.mix_sources(spark, documents, "").count()
    mapped = documents.withColumn("tags", F.when(F.col("doc_id") < 5, F.create_map(F.lit("a"), F.col("n_chars")))).withColumn("deep", F.array(F.create_map(F.lit("b"), F.lit(1))))
    out = corpus_pipeline.mix_sources(spark, mapped, "")
    assert out.columns == mapped.columns and out.count() == plain_rows


def test_accepted_keeps_whole_rows(spark, documents):
    model = language_id.learn(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), steps=20)
    kept = language_id.accepted(documents, model, 0.0)
    assert kept.columns == documents.columns
    assert plain(kept) == [r for r in plain(documents) if any(c.isalpha() for c in r["text"] or "")]
