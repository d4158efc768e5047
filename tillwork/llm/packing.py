"""Pack documents into sequences by minimum bin slack.

A bin starts with the longest piece left. A bitset of reachable sums, one shift per piece, finds
the fullest feasible combination of the lengths that remain; its pieces leave and the next bin
starts. Pieces are dealt into groups of a fixed size, each packed by one task; a group leaves
at most one bin that is not about full.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, saved
from tillwork.llm.tokens import sent, tokenized, worker_encoder

GROUP = 16_384  # pieces packed together


def fullest(room: int, lengths: list[int], left: dict[int, int]) -> list[int]:
    """The pieces that fill most of the room; lengths ascend and have left[length] > 0 pieces each."""
    reach, target, steps = 1, 1 << room, []
    mask = (target << 1) - 1
    for length in reversed(lengths[: bisect_right(lengths, room)]):
        for _ in range(min(left[length], room // length)):
            new = (reach << length) & mask & ~reach
            if not new:
                break
            steps.append((length, new))
            reach |= new
        if reach & target:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, new in reversed(steps):
        if new >> total & 1:  # this sum was first reached with this piece
            chosen.append(length)
            total -= length
    return chosen


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; sizes are 1 to capacity."""
    rows: dict[int, list[int]] = {}
    for row in np.argsort(sizes, kind="stable").tolist():
        rows.setdefault(int(sizes[row]), []).append(row)
    lengths, left = list(rows), {length: len(r) for length, r in rows.items()}
    at, offset, number = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    while lengths:
        first = lengths[-1]
        left[first] -= 1
        if not left[first]:
            lengths.pop()
        chosen = fullest(capacity - first, lengths, left)
        for length in chosen:
            left[length] -= 1
        for length in set(chosen):
            if not left[length]:
                lengths.remove(length)
        used = 0
        for length in [first, *chosen]:
            row = rows[length].pop()
            at[row], offset[row] = number, used
            used += length
        number += 1
    return at, offset


def token_pieces(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document cut at capacity, with the task and its row number."""
    file = sent(docs.sparkSession, vocabulary_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pid, number = worker_encoder(file.value, end_id), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, ids, first in tokenized(batch, encoder):
                pieces = -(-np.diff(first) // capacity)
                doc = np.repeat(np.arange(part.num_rows), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(np.diff(first)[doc] - start, capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                begin = (first[doc] + start) * 4
                crc = [zlib.crc32(raw[b : b + 4 * n]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()), pa.array(np.full(len(doc), pid, np.int32)), pa.array(np.arange(number, number + len(doc)), pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "pid", "number"],
                )
                number += len(doc)

    return docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, number long")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = 4096, end_id: int = 1, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    A document is its ids and the end id; one longer than the capacity is cut, the last piece may
    be shorter. A full piece is a sequence of its own. Null text is empty: a piece of the end id
    alone. Repeated rows and rows with a null doc_id are packed like others. Empty in, empty out.
    """
    texts = narrow(docs, "doc_id", "text")
    pieces = saved(token_pieces(texts, vocabulary_path, end_id, capacity), "pieces")
    short = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("pid", "ascending"), ("number", "ascending")])  # the rows come in any order
        at, offset = pack(table["length"].to_numpy(), capacity)
        ids = (int(table["group"][0].as_py()) << 32) + at
        return table.drop_columns(["group", "pid", "number"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    packed = short.withColumn("group", F.pmod(F.xxhash64("pid", "number"), F.lit(groups))).groupBy("group").applyInArrow(fill, out)
    alone = F.expr("-1 - (shiftleft(cast(pid AS long), 40) + number)")
    full = pieces.filter(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.union(packed)
