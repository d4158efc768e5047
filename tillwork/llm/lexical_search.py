"""Ranked lexical search with the Best Position Algorithm over impact lists.

The documents are an index cut by document: every task reads its share of the term counts, builds for each query
term the list of its documents by falling impact, and answers all items on it; the best of the shares are the
best of all. Within a share, all lists of an item are read by position in step. Every document met is looked up
in the item's other lists at once (direct access), which marks its positions there as seen too. A list's best
position is the end of its unbroken run of seen positions; a document not met yet lies behind it in every list,
so the impacts there bound its score, more tightly than those of the positions read last. Reading stops when
that bound is strictly below the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, saved
from tillwork.llm.words import find_words, text_slices, word_hashes

K = 10
FIRST_READ = 16  # positions read of each list in the first step; each step reads twice as many as the last
SHARE_POSTINGS = 1 << 20  # postings (document, query term) of a share of the index
QUERY_TERMS = 100_000  # item terms searched for in one pass over the index; more items take more passes
FILTER_BITS = 24  # of a term's hash: the size of the filter, 2 MB, whatever the number of terms

_COUNTED = "pid int, number long, id long, n long, terms array<long>, tfs array<int>"


def _in_filter(bits: np.ndarray | None, terms: np.ndarray) -> np.ndarray:
    place = terms >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def count_terms(texts: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """pid, number, id, n, terms and tfs of every row (id, text): n its terms with repeats, terms the distinct ones as 64-bit
    hashes, only those that pass the filter, if there is one."""
    bits = None if wanted is None else texts.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                words = find_words(data, offsets)
                terms, rows = word_hashes(words), part.num_rows
                doc = np.repeat(np.arange(rows), np.diff(words.first))
                if bits is not None:
                    kept = _in_filter(bits.value, terms)
                    terms, doc = terms[kept], doc[kept]
                order = np.lexsort((terms, doc))
                terms, doc = terms[order], doc[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (terms[1:] != terms[:-1])
                start = np.flatnonzero(new)
                tfs = np.diff(np.append(start, len(doc))).astype(np.int32)
                first = pa.array(np.searchsorted(doc[start], np.arange(rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, pid, np.int32)), pa.array(np.arange(number, number + rows)), part.column("id"), pa.array(np.diff(words.first).astype(np.int64)),
                        pa.ListArray.from_arrays(first, pa.array(terms[start].view(np.int64))), pa.ListArray.from_arrays(first, pa.array(tfs)),
                    ],
                    names=["pid", "number", "id", "n", "terms", "tfs"],
                )
                number += rows

    return texts.mapInArrow(count, _COUNTED)


def term_filter(terms: DataFrame) -> np.ndarray:
    """A bit for each value of the upper hash bits that some term has; at most 2^18 words come to the driver."""
    place = F.shiftrightunsigned("term", 64 - FILTER_BITS)
    word, bit = F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))")
    rows = terms.select(place.alias("place"), word).groupBy("word").agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    length = stop - start
    until = np.cumsum(length)
    return np.arange(until[-1] if len(until) else 0) + np.repeat(start - (until - length), length)


class ImpactIndex:
    """The impact lists of some documents, and where each document stands in them.

    Postings come by document; doc, term (numbers below `terms`) and value (without the term's weight) are parallel.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int, terms: int):
        order = np.lexsort((doc, -value, term))
        self.doc, self.value = doc[order], value[order]  # list after list, by falling impact
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        self.place = np.empty(len(order), np.int64)  # of the postings by document
        self.place[order] = np.arange(len(order))
        self.term_of, self.doc_of = term, doc
        self.first = np.searchsorted(doc, np.arange(docs + 1))
        self._list = np.full(terms, -1)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores of all documents (0 for those not met) such that the k best are right, ties at the k-th included; which
        documents were met; and how many positions were read."""
        some = self.start[terms + 1] > self.start[terms]
        terms, weights = terms[some], weights[some]
        docs = len(self.first) - 1
        score, met = np.zeros(docs, np.int64), np.zeros(docs, bool)
        start, length = self.start[terms], self.start[terms + 1] - self.start[terms]
        if not len(terms):
            return score, met, 0
        begin = np.cumsum(length) - length  # of each list in the item's own row of positions
        seen = np.zeros(int(length.sum()), bool)
        places = np.arange(len(seen))
        self._list[terms] = np.arange(len(terms))
        depth, step, read = 0, FIRST_READ, 0
        while True:
            at = _ranges(start + np.minimum(depth, length), start + np.minimum(depth + step, length))  # sorted access
            read += len(at)
            fresh = np.unique(self.doc[at])
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            postings = _ranges(self.first[fresh], self.first[fresh + 1])  # direct access
            of = self._list[self.term_of[postings]]
            postings, of = postings[of >= 0], of[of >= 0]
            place = self.place[postings]
            np.add.at(score, self.doc_of[postings], weights[of] * self.value[place])
            seen[begin[of] + place - start[of]] = True
            unseen = np.minimum.reduceat(np.where(seen, len(seen), places), begin)  # right behind the best position
            open_ = unseen < len(seen)
            bound = int((weights[open_] * self.value[(start + unseen - begin)[open_]]).sum())
            good = score[score > 0]
            if bound == 0 or (len(good) >= k and bound < np.partition(good, len(good) - k)[len(good) - k]):
                break
            depth, step = depth + step, step * 2
        self._list[terms] = -1
        return score, met, read


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _answer(shares: list[pa.RecordBatch], item: np.ndarray, first: np.ndarray, term: np.ndarray, weight: np.ndarray, n_docs: int, total: int, k: int) -> pa.RecordBatch:
    """The k best documents of these rows of counted terms for each item; item i has the terms first[i] to first[i + 1]."""
    rows = pa.Table.from_batches(shares).combine_chunks()
    n = rows["n"].to_numpy()
    lists = rows["terms"].combine_chunks()
    doc = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
    found, tf = lists.flatten().to_numpy(), rows["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
    known, of_item = np.unique(term, return_inverse=True)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    wanted = known[at] == found
    doc, tf, at = doc[wanted], tf[wanted], at[wanted]
    long = 10 + 90 * n * n_docs // total
    index = ImpactIndex(doc, at, 1_000_000_000 * tf // (1000 * tf + 8 * long[doc]), len(rows), len(known))
    ids = rows["id"].combine_chunks()
    no_id, by_id = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    out = []
    for i, key in enumerate(item):
        mine = slice(first[i], first[i + 1])
        score, _, _ = index.search(of_item[mine], weight[mine], k)
        good = np.flatnonzero(score)
        if len(good) > k:
            good = good[score[good] >= np.partition(score[good], len(good) - k)[len(good) - k]]
        good = good[np.lexsort((by_id[good], no_id[good], -score[good]))[:k]]
        out.append((np.full(len(good), key), good, score[good]))
    keys, docs, scores = (np.concatenate(c) for c in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids.take(pa.array(docs, pa.int64())), pa.array(scores, pa.int64())], schema=_FOUND)


def _search_pass(counted: DataFrame, asked: pa.Table, n_docs: int, total: int, k: int, share: int) -> DataFrame:
    """The k best documents for each item of `asked` (item, term, weight) in every share of the index."""
    asked = asked.sort_by([("item", "ascending"), ("term", "ascending")])
    item, start = np.unique(asked["item"].to_numpy(), return_index=True)
    held = (item, np.append(start, len(asked)), asked["term"].to_numpy(), asked["weight"].to_numpy())
    terms = counted.sparkSession.sparkContext.broadcast(held)  # at most QUERY_TERMS, or one item's own

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares, postings = [], 0
        for batch in batches:
            shares.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= share:
                yield _answer(shares, *terms.value, n_docs, total, k)
                shares, postings = [], 0
        if shares:
            yield _answer(shares, *terms.value, n_docs, total, k)

    return counted.select("id", "n", "terms", "tfs").mapInArrow(search, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, share: int = SHARE_POSTINGS, query_terms: int = QUERY_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest scores above 0 for each item.

    docs: doc_id, text; items: item_id, text. Terms are runs of letters, digits and non-ASCII characters with A-Z
    lower-cased; a null text has none. With N documents that have a term, L their terms, n a document's terms and
    df the documents that have a term, a document scores the sum, over the item's distinct terms, of
    floor(1000 ln((2N+2)/(2df+1))) * (10^9 tf div (1000 tf + 8m)), m = 10 + (90 n N div L).

    Every row is a document or an item of its own, also with a repeated or null id; equal scores go by doc_id, nulls
    last. An item without terms, or whose terms no document has, gives no rows, nor do empty tables. Terms are told apart by
    64-bit hashes. The index is not shuffled: what leaves a share of it is k rows for each item.
    """
    spark = docs.sparkSession
    number = F.shiftleft(F.col("pid").cast("long"), 40).bitwiseOR(F.col("number"))
    texts = narrow(items, "item_id", "text").select(F.col("item_id").cast("long").alias("id"), "text")
    asking = saved(count_terms(texts).select(number.alias("item"), F.col("id").alias("item_id"), "terms"), "items")
    item_terms = asking.select("item", F.explode("terms").alias("term"))
    vocabulary = saved(item_terms.select("term").distinct(), "vocabulary")
    texts = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("id"), "text")
    counted = saved(count_terms(texts, term_filter(vocabulary)), "counted")
    n_docs, total = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    weights = df.join(vocabulary, "term").select("term", weight.cast("long").alias("weight")).filter("weight > 0")
    asked = saved(item_terms.join(weights, "term"), "asked")
    passes = max(1, -(-asked.count() // query_terms))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item"), F.lit(passes)))
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for p in range(passes):
        held = asked.filter(F.col("pass") == p).select("item", "term", "weight").toArrow()
        if len(held):
            found = found.union(_search_pass(counted, held, n_docs, total, k, share))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(asking.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
