"""SimHash near-duplicates: a pivot table of Hamming distances to reference fingerprints discards pairs.

Every distinct fingerprint is one node. Its Hamming distances to a fixed number of reference fingerprints are its row of the
pivot table. Two fingerprints at most `most` bits apart differ by at most `most` in every column, so a pair
whose largest difference is more is discarded; the others are verified on the fingerprints.

The same bound deals the work out: a cell of too many fingerprints is split at a distance to a reference into near and far,
and those near ones that are within `most` of the border go to both sides, so a pair always meets in some cell. The
references and borders of a cell are chosen from counts of its distances; cells that no reference splits
well are verified block against block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.graph import components
from tillwork.llm.shared import mix64, narrow, partitions, saved

WIDTH = 3
MOST = 2  # differing bits of linked fingerprints
SEED = 42
REFERENCES = 32
SAMPLE = 1024  # fingerprints on the driver from which references are chosen
CELL = 2048  # fingerprints of a cell that splits aim at
OVERFULL = 4  # times as many are split again, or else compared in blocks
SPLITS = 32  # of a cell in a round, at most
WORTH = 0.85  # a split must leave less than this share of a cell's pairs
TEXT_BYTES = 1 << 20  # of a long text worked on at a time
_CELLS = 1 << 20  # entries of a block of pairs
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes, limit: int) -> Iterator[list[bytes]]:
    """The words of a text, in lists; a piece ends at white space."""
    at = 0
    while at < len(text):
        gap = _SPACE.search(text, at + limit)
        to = gap.start() if gap else len(text)
        yield text[at:to].split()
        at = to


def _bit_counts(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """How many hashes of the runs of `width` words have each bit, highest bit first, and how many there are."""
    line = b" ".join(words)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], stop[:-1] + 1])
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(start[: len(words) - width + 1].tolist(), stop[width - 1 :].tolist(), strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64), len(bits)


def fingerprint(text: bytes | None, width: int = WIDTH, limit: int = TEXT_BYTES) -> int:
    """The SimHash of a text: a bit is 1 if over half of the shingles' XXH64 hashes have it; 0 without words.

    Words are runs of other than ASCII white space with A-Z lower-cased, shingles the space-joined runs of `width` words, repeats
    included; of fewer words all are one shingle.
    """
    ones, total, carried = np.zeros(64, np.int64), 0, []
    for words in _pieces((text or b"").lower(), limit):
        words = carried + words
        if len(words) >= width:
            counts, n = _bit_counts(words, width)
            ones, total = ones + counts, total + n
            words = words[len(words) - width + 1 :]
        carried = words
    if not total and carried:
        ones, total = _bit_counts(carried, len(carried))
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a long) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            marks = np.array([fingerprint(t.as_py(), width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], names=["doc_id", "fingerprint"])

    texts = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(sign, "doc_id long, fingerprint long")


def distances(marks: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The pivot table: a row of Hamming distances to the references for each fingerprint."""
    return np.bitwise_count(marks[:, None] ^ references).astype(np.int8)


def choose_references(sample: np.ndarray, count: int = REFERENCES, most: int = MOST) -> np.ndarray:
    """References that tell pairs of the sample apart: each one the most of those pairs which no chosen one does yet.

    Fixed random words are candidates too, so there are enough of them, whatever the sample.
    """
    rng = np.random.default_rng(20240607)
    spare = rng.integers(0, 2**64, 4 * count, dtype=np.uint64)
    candidates = np.concatenate([sample[: 8 * count], spare])
    points = np.concatenate([sample, spare[:1]])
    left, right = points[rng.integers(0, len(points), 4096)], points[rng.integers(0, len(points), 4096)]
    apart = np.abs(distances(left, candidates) - distances(right, candidates)) > most
    todo, free, chosen = np.ones(len(apart), bool), np.ones(len(candidates), bool), []
    for _ in range(count):
        gain = np.where(free, apart[todo].sum(axis=0), -1)
        if gain.max() <= 0:  # all that can be told apart are: begin anew
            todo[:] = True
            gain = np.where(free, apart.sum(axis=0), -1)
        best = int(gain.argmax())
        chosen.append(best)
        free[best] = False
        todo &= ~apart[:, best]
    return candidates[chosen]


def choose_splits(counts: np.ndarray, most: int, cell: int) -> list[tuple[int, int]]:
    """(reference, border) of the splits of a cell whose fingerprints have these counts of distances to each reference.

    Near is up to the border; the last `most` distances before it go to both sides. A split is worth as little as it leaves
    of the cell's pairs; those not worth WORTH are left out, and so are more than the size asks for.
    """
    total = int(counts[0].sum())
    near = np.cumsum(counts, axis=1)
    both = near - np.concatenate([np.zeros((len(counts), most), near.dtype), near[:, :-most]], axis=1) if most else np.zeros_like(near)
    left = (near / total) ** 2 + ((total - near + both) / total) ** 2
    border = left.argmin(axis=1)
    left = left[np.arange(len(left)), border]
    wanted = min(SPLITS, int(np.ceil(np.log2(total / cell) / 0.7)))
    best = [int(r) for r in np.argsort(left, kind="stable")[:wanted] if left[r] <= WORTH]
    return [(r, int(border[r])) for r in best]


def _count_distances(placed: DataFrame, references: np.ndarray) -> DataFrame:
    """cell, reference, distance, n of the rows (cell, fingerprint), summed once in each batch."""
    width = len(references) * 65

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, which = np.unique(batch.column("cell").to_numpy(), return_inverse=True)
            table = distances(batch.column("fingerprint").to_numpy().view(np.uint64), references)
            code = which[:, None] * width + np.arange(len(references)) * 65 + table
            code, n = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells[code // width]), pa.array((code % width // 65).astype(np.int32)), pa.array((code % 65).astype(np.int32)), pa.array(n)],
                names=["cell", "reference", "distance", "n"],
            )

    part = placed.select("cell", "fingerprint").mapInArrow(count, "cell long, reference int, distance int, n long")
    return part.groupBy("cell", "reference", "distance").agg(F.sum("n").alias("n"))


def _splits(placed: DataFrame, references: np.ndarray, most: int, cell: int) -> DataFrame:
    """cell, refs and borders of the cells worth splitting."""
    out = pa.schema([("cell", pa.int64()), ("refs", pa.list_(pa.int32())), ("borders", pa.list_(pa.int32()))])

    def choose(table: pa.Table) -> pa.Table:
        counts = np.zeros((len(references), 65), np.int64)
        counts[table["reference"].to_numpy(), table["distance"].to_numpy()] = table["n"].to_numpy()
        chosen = choose_splits(counts, most, cell)
        if not chosen:
            return out.empty_table()
        refs, borders = zip(*chosen, strict=True)
        return pa.table([[table["cell"][0].as_py()], [list(refs)], [list(borders)]], schema=out)

    return _count_distances(placed, references).groupBy("cell").applyInArrow(choose, "cell long, refs array<int>, borders array<int>")


def _dealt(rows: DataFrame, references: np.ndarray, most: int) -> DataFrame:
    """Rows (fingerprint, cell, refs, borders) to (fingerprint, cell) of the cells' parts, border rows in both."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, borders = batch.column("refs"), batch.column("borders")
            first = refs.offsets.to_numpy()
            length, first = np.diff(first), first[:-1]
            refs, borders = refs.values.to_numpy(), borders.values.to_numpy()
            marks = batch.column("fingerprint").to_numpy().view(np.uint64)
            cells, row = batch.column("cell").to_numpy().view(np.uint64), np.arange(batch.num_rows)
            for s in range(int(length.max(initial=0))):
                has = length[row] > s
                at = np.where(has, first[row] + s, 0)
                gap = np.bitwise_count(marks[row] ^ references[refs[at]]).astype(np.int64) - borders[at]
                side = np.where(has, np.where(gap > 0, 2, 1), 0).astype(np.uint64)
                also = has & (gap <= 0) & (gap > -most)
                cells = np.concatenate([np.where(has, mix64(cells * np.uint64(3) + side), cells), mix64(cells[also] * np.uint64(3) + np.uint64(2))])
                row = np.concatenate([row, row[also]])
            yield pa.RecordBatch.from_arrays([pa.array(marks[row].view(np.int64)), pa.array(cells.view(np.int64))], names=["fingerprint", "cell"])

    return rows.select("fingerprint", "cell", "refs", "borders").mapInArrow(deal, "fingerprint long, cell long")


def near_pairs(marks: np.ndarray, references: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places i, j of all pairs at most `most` bits apart (each once), by the pivot table; and how many pairs were verified."""
    table = distances(marks, references)
    spread = np.argsort(-table.std(axis=0), kind="stable")
    table = table[:, spread]
    order = np.argsort(table[:, 0], kind="stable")
    table, sorted_marks = table[order], marks[order]
    key = table[:, 0].astype(np.int64)
    found, verified = [], 0
    at = 0
    while at < len(key):
        same = int(np.searchsorted(key, key[at], "right"))
        stop = int(np.searchsorted(key, key[at] + most, "right"))
        step = min(same, at + max(1, _CELLS // max(1, stop - at)))
        kept = np.arange(at, step)[:, None] < np.arange(at, stop)
        for c in range(1, min(4, table.shape[1])):
            kept &= np.abs(table[at:step, c, None] - table[None, at:stop, c]) <= most
        i, j = np.nonzero(kept)
        i, j = i + at, j + at
        for c in range(4, table.shape[1], 7):  # the other columns, on what is left
            fine = (np.abs(table[i, c : c + 7] - table[j, c : c + 7]) <= most).all(axis=1)
            i, j = i[fine], j[fine]
        verified += len(i)
        near = np.bitwise_count(sorted_marks[i] ^ sorted_marks[j]) <= most
        found.append((order[i[near]], order[j[near]]))
        at = step
    i, j = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    return i, j, verified


def _links(references: np.ndarray, most: int):
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def link(table: pa.Table) -> pa.Table:
        marks = table["fingerprint"].to_numpy()
        if len(marks) < 2:
            return schema.empty_table()
        i, j, _ = near_pairs(marks.view(np.uint64), references, most)
        root = np.arange(len(marks))
        while len(i):
            least = root.copy()
            np.minimum.at(least, i, root[j])
            np.minimum.at(least, j, root[i])
            least = least[least]
            if (least == root).all():
                break
            root = least
        some = root != np.arange(len(marks))
        return pa.Table.from_arrays([pa.array(marks[some]), pa.array(marks[root[some]])], schema=schema)

    return link


def near_links(marks: DataFrame, most: int = MOST, references: int = REFERENCES, cell: int = CELL) -> DataFrame:
    """Links (src, dst) that connect exactly the fingerprints which chains of at most `most` differing bits connect.

    marks: fingerprint (a long), each once. In a cell every linked fingerprint is linked to the cell's first of its chain only.
    """
    spark = marks.sparkSession
    sample = [r[0] for r in marks.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()]
    pivots = choose_references(np.array(sample, np.int64).view(np.uint64), references, most)
    open_, done = saved(marks.select("fingerprint", F.lit(0).cast("long").alias("cell")), "cells"), []
    while True:
        sizes = open_.groupBy("cell").agg(F.count("*").alias("held"))
        large = saved(sizes.filter(F.col("held") > OVERFULL * cell).select("cell"), "large")
        splits = saved(_splits(open_.join(large, "cell", "left_semi"), pivots, most, cell), "splits")
        if splits.isEmpty():
            done.append(open_)
            break
        done.append(open_.join(splits.select("cell"), "cell", "left_anti"))
        open_ = saved(_dealt(open_.join(splits, "cell"), pivots, most), "cells")
    placed = done[0]
    for part in done[1:]:
        placed = placed.unionByName(part)
    blocks = F.ceil(F.count("*") / (OVERFULL * cell)).cast("int").alias("blocks")
    placed = placed.join(placed.groupBy("cell").agg(blocks, F.count("*").alias("held")).filter("held > 1"), "cell")
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fingerprint"), "blocks")).otherwise(0).cast("int")
    paired = placed.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select("fingerprint", "cell", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    paired = paired.repartition(partitions(spark), "cell", "one", "two")
    return paired.groupBy("cell", "one", "two").applyInArrow(_links(pivots, most), "src long, dst long")


def near_fingerprints(docs: DataFrame, width: int = WIDTH, most: int = MOST, references: int = REFERENCES, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    component_id is the smallest doc_id of the documents that chains of fingerprints at most `most` bits apart connect,
    itself included. Null, empty and wordless texts have the fingerprint 0, which links like any other. Repeated rows
    and texts of one doc_id are rows of their own; a row without a doc_id links too, its component_id is null
    where no linked row has one. Empty in, empty out.
    """
    signed = saved(fingerprints(docs, width), "fingerprints")
    marks = saved(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "marks")
    linked = components(near_links(marks, most, references, cell)).withColumnRenamed("id", "fingerprint")
    class_of = marks.join(linked, "fingerprint", "left").select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    smallest = class_of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = saved(class_of.join(smallest, "component").select("fingerprint", "component_id"), "classes")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return signed.join(named, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
