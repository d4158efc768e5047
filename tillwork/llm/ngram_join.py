"""Near-duplicate join on word n-grams: MinHash bands propose, full n-gram sets verify.

Texts of equal words are one node from the start, however many copies there are. Nodes that meet in
a band's bucket are linked to the bucket's smallest node, never to each other, and the
components of these links are the candidate groups. Within a group every pair is verified on
the full n-gram sets, block against block; a block pair returns one row per node (its links counted,
its smallest relative), never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.graph import components
from tillwork.llm.shared import mix64, narrow, partitions, saved
from tillwork.llm.words import find_words, shingle_hashes, text_slices, word_hashes

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999  # of pairs exactly at the threshold; more alike pairs are missed less often
MAX_HASHES = 200
BLOCK = 256  # nodes of a group verified against each other in one step
BLOCK_BYTES = 4 << 20  # and the texts of a block, on average
_CELLS = 1 << 20  # entries of the dense block matrix held at a time


def plan_bands(threshold: float, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false candidates, that reach the recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for this threshold and recall")
    return best


def _signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    rng = np.random.default_rng(20240229)
    multiply = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    flip = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                words = find_words(data, offsets)
                shingles, first = shingle_hashes(word_hashes(words), words.first, width)
                n = np.diff(first)
                full = np.flatnonzero(n)
                out = np.zeros((len(full), bands), np.uint64)
                sums = np.zeros((2, len(full)), np.uint64)
                if len(full):
                    at = first[full]
                    sums[0] = np.add.reduceat(shingles, at)
                    sums[1] = np.add.reduceat(mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)), at)
                    small = (shingles >> np.uint64(32)).astype(np.uint32)
                    for b in range(bands):
                        bucket = np.full(len(full), b + 1, np.uint64)
                        for j in range(b * rows, (b + 1) * rows):
                            bucket = mix64(bucket ^ np.minimum.reduceat((small ^ flip[j]) * multiply[j], at))
                        out[:, b] = bucket
                counts = np.where(n > 0, bands, 0)
                spread = [np.zeros(part.num_rows, np.int64) for _ in sums]
                for s, value in zip(spread, sums, strict=True):
                    s[full] = value.view(np.int64)
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(out.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("mark"), pa.array(n, pa.int64()), *map(pa.array, spread), listed],
                    names=["doc_id", "mark", "n", "key1", "key2", "buckets"],
                )

    return docs.mapInArrow(sign, "doc_id long, mark long, n long, key1 long, key2 long, buckets array<long>")


def _shared_counts(doc: np.ndarray, gram: np.ndarray, docs: int) -> np.ndarray:
    """How many n-grams each two documents share; doc and gram are the distinct pairs."""
    common = np.bincount(gram)[gram] > 1
    doc = doc[common]
    _, gram = np.unique(gram[common], return_inverse=True)
    shared = np.zeros((docs, docs), np.int64)
    order = np.argsort(gram, kind="stable")
    doc, gram = doc[order], gram[order]
    step = max(1, _CELLS // docs)
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, step):
        lo, hi = np.searchsorted(gram, [low, low + step])
        there = np.zeros((docs, step), np.float32)
        there[doc[lo:hi], gram[lo:hi] - low] = 1
        shared += (there @ there.T).astype(np.int64)
    return shared


def _verify(width: int, threshold: float):
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def verify(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        copies, block = table["copies"].to_numpy(), table["block"].to_numpy()
        across = table["one"][0].as_py() != table["two"][0].as_py()
        if across and block.min() == block.max():  # the other block has no node
            return schema.empty_table()
        docs, grams, seen = [], [], 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for part, data, offsets in text_slices(batch, "text"):
                words = find_words(data, offsets)
                shingles, first = shingle_hashes(word_hashes(words), words.first, width)
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                order = np.lexsort((shingles, doc))
                doc, shingles = doc[order], shingles[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (shingles[1:] != shingles[:-1])
                docs.append(doc[new] + seen)
                grams.append(shingles[new])
                seen += part.num_rows
        doc = np.concatenate(docs)
        _, gram = np.unique(np.concatenate(grams), return_inverse=True)
        size = np.bincount(doc, minlength=len(node))
        shared = _shared_counts(doc, gram, len(node))
        linked = shared / (size[:, None] + size[None, :] - shared) >= threshold
        np.fill_diagonal(linked, False)
        if across:  # pairs within a block are another task's
            linked &= block[:, None] != block[None, :]
        root = node.copy()
        while True:
            least = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (least == root).all():
                break
            root = least
        some = linked.any(axis=1)
        return pa.Table.from_arrays([pa.array(x[some]) for x in (node, root, linked @ copies)], schema=schema)

    return verify


def text_mark(text: Column) -> Column:
    """With the doc_id, what tells a text from others of that doc_id."""
    return F.xxhash64(text)


def _classes(docs: DataFrame, threshold: float, width: int, recall: float, max_hashes: int, null_ids: bool) -> DataFrame:
    """doc_id, mark and n of every document, with node, class (the smallest node reachable), least (the class's
    smallest doc_id) and links; these four are null for a text without words.

    A node is all texts of equal words and has a number of its own, so a doc_id may come with several texts.
    With null_ids rows with a null doc_id are compared too; else they count for nothing.
    """
    bands, rows = plan_bands(threshold, recall, max_hashes)
    texts = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_mark(F.col("text")).alias("mark"))
    signed = saved(_signatures(texts, width, bands, rows), "signatures")
    keyed = signed.filter("n > 0" if null_ids else "n > 0 AND doc_id IS NOT NULL")
    key = ["key1", "key2", "n"]
    # one node for all texts of equal words; the row of its first document stands for it
    nodes = keyed.groupBy(*key).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"), F.count("*").alias("copies"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), *key, F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark"), "copies")
    nodes = saved(nodes, "nodes")
    names = nodes.select("node", *key, F.col("doc_id").alias("node_doc_id"), F.col("mark").alias("node_mark"))
    stands = F.col("doc_id").eqNullSafe(F.col("node_doc_id")) & (F.col("mark") == F.col("node_mark"))
    of_node = keyed.join(names.drop(*key), stands).dropDuplicates(["node"])
    in_bucket = of_node.select("node", F.explode("buckets").alias("bucket"))
    met = in_bucket.groupBy("bucket").agg(F.min("node").alias("least"), F.count("*").alias("nodes")).filter("nodes > 1")
    proposed = in_bucket.join(met, "bucket").filter("node <> least").select(F.col("node").alias("src"), F.col("least").alias("dst"))
    groups = saved(components(proposed), "groups")

    members = groups.withColumnRenamed("id", "node").join(names.drop(*key), "node").join(nodes.select("node", "copies"), "node")
    members = members.join(texts, stands).dropDuplicates(["node"]).select("component", "node", "copies", "text")
    members = saved(members, "members")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int")
    members = members.join(members.groupBy("component").agg(blocks.alias("blocks")), "component")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    paired = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", "node", "copies", "text", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    )
    # many small tasks: the work of a block pair is in its pairs, not its bytes
    paired = paired.repartition(partitions(docs.sparkSession), "component", "one", "two")
    verified = saved(
        paired.groupBy("component", "one", "two").applyInArrow(_verify(width, threshold), "node long, root long, links long"), "verified"
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(verified.select(F.col("node").alias("src"), F.col("root").alias("dst"))).withColumnRenamed("id", "node")
    least = linked.join(nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("least"))
    judged = nodes.join(links, "node", "left").join(linked.join(least, "component"), "node", "left").select(
        *key, "node", F.coalesce("component", "node").alias("class"), F.coalesce("least", "doc_id").alias("least"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    return signed.drop("buckets").join(judged, key, "left")


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL, max_hashes: int = MAX_HASHES,
) -> DataFrame:
    """doc_id, class_id and links of every document.

    links counts the other documents whose sets of word n-grams have a Jaccard similarity of at least
    `threshold` with its own, copies included; class_id is the smallest doc_id reachable over such
    links. A text of fewer than `width` words has one n-gram, all its words; a text without words
    (also null) is alike to none. Repeated rows are copies. A row with a null doc_id has no
    class and no links. Every text of a doc_id is compared and has a class of its own. Empty in, empty out.
    """
    found = _classes(docs, threshold, width, recall, max_hashes, null_ids=False)
    known = F.col("doc_id").isNotNull()
    return found.select(
        "doc_id", F.when(known, F.coalesce("least", "doc_id")).alias("class_id"), F.when(known, F.coalesce("links", F.lit(0))).otherwise(0).alias("links")
    )


def first_of_classes(
    docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL, max_hashes: int = MAX_HASHES,
) -> DataFrame:
    """doc_id and mark (text_mark of its text) of one document of each class of near copies, the smallest doc_id, nulls last.

    Documents with a null doc_id are compared like others. Texts without words have no class and are not listed.
    """
    found = _classes(docs, threshold, width, recall, max_hashes, null_ids=True).filter("n > 0")
    first = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
    return first.select("first.doc_id", "first.mark")
