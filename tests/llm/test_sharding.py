import itertools
import zlib

import numpy as np

from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm.oracles import hilbert_shards as shard_sql
from tillwork.llm.sharding import hilbert_index, hilbert_shards, write_shards


def test_curve_visits_every_cell_once_in_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_equals_sql(spark):
    import duckdb

    file = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{file}'")
    got = hilbert_shards(spark.read.parquet(file), 8).select("doc_id", "size", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(shard_sql(8)).fetchall())


def test_hard_rows(spark, documents):
    rows = plain(hilbert_shards(documents, 8))
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect() if r["doc_id"]}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows if r["doc_id"])
    counts = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)]
    assert all(c == list(range(len(c))) for c in counts) and max(map(len, counts)) - min(map(len, counts)) <= 1
    assert rows == plain(hilbert_shards(documents.repartition(3), 8))
    assert hilbert_shards(documents.limit(0), 8).count() == 0


def test_shards_prune_and_keep_every_document(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    back = write_shards(docs, str(tmp_path / "out"), 8)
    assert back.count() == docs.count() and set(docs.columns) < set(back.columns)
    touched = back.select("shard", "source").distinct().count()
    assert touched < 0.8 * 8 * docs.select("source").distinct().count()  # a filter on a source skips shards


def test_shards_of_hard_rows(spark, documents, tmp_path):
    """Null and repeated doc_ids, a column called shard, names that clash with those used inside."""
    docs = documents.drop("n.x").withColumnRenamed("pid", "row_number")
    back = write_shards(docs, str(tmp_path / "out"), 3)
    assert back.columns == [*docs.columns, "shard_"]
    assert plain(back.drop("shard_")) == plain(docs)
    sizes = [r["count"] for r in back.groupBy("shard_").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
