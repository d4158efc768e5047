"""Token ids in a compact binary format: adaptive context mixing and a range coder.

A block holds whole documents. Its ids are laid out in lanes, contiguous runs coded in lock step, so
that one numpy operation serves all lanes; the lanes share the block's model. Three orders predict an
id: order 2 and order 1 each name the id last seen after their context, with a confidence;
order 0 counts all ids. A mixing context made of the two confidences and whether the predictions agree
learns how much of the probability each order gets; an id's interval is its order's share, divided by
the counts where it falls to order 0. Every block starts from an empty model and carries checksums of its bytes
and of its ids, so a block can be read alone and damage is found.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, partitions
from tillwork.llm.tokens import sent, tokenized, worker_encoder

BLOCK_TOKENS = 1 << 21  # a block ends with the document that reaches this
LANES = 8192
MIN_STEPS = 64  # a short block has fewer lanes
_MAGIC = b"TWCM"
_HEADER = struct.Struct("<4sBIQQIIII")  # magic, version, documents, ids, ids before, lanes, vocabulary, checksum of ids, checksum of the rest
_VERSION = 2  # of the layout and of the model; either changing makes a new version

_CONTEXT_BITS = 18  # of the order-2 table
_MIX_BITS, _ORDER0_BITS = 12, 19
_SURE_BITS = 3
_MOST_SURE = (1 << _SURE_BITS) - 1
_RENEW = 8  # steps between renewals of the order-0 intervals
_GAIN = 24  # what an occurrence adds to an id's count
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 40)
_MISS = 2  # outcomes: 0 as order 2 said, 1 as order 1 said, 2 neither


class _Model:
    """What a block has learned; the encoder and the decoder keep equal copies.

    A prediction is an id and, in its low bits, how sure it is.
    """

    def __init__(self, vocabulary: int, lanes: int, decoding: bool):
        self.vocabulary, self.decoding = vocabulary, decoding
        self.bits0 = max(_ORDER0_BITS, vocabulary.bit_length() + 2)
        self.said = [np.zeros(1 << _CONTEXT_BITS, np.int32), np.zeros(vocabulary + 1, np.int32)]  # by order 2, order 1
        contexts = (_MOST_SURE + 1) ** 2 * 2
        self.outcomes = np.tile(np.array([1, 1, 2], np.int64), (contexts, 1))
        self.counts = np.ones(vocabulary, np.int64)
        self.pending: list[np.ndarray] = []
        self.before = np.full((2, lanes), vocabulary, np.int64)  # the two ids before, of every lane
        self.step = 0
        self.renew()

    def renew(self) -> None:
        """Intervals of all outcomes, and now and then of all ids, from the counts so far."""
        if self.step % _RENEW == 0 or self.step < _RENEW:
            if self.pending:
                self.counts += _GAIN * np.bincount(np.concatenate(self.pending), minlength=self.vocabulary)
                self.pending = []
            until = np.cumsum(self.counts)
            spare = ((1 << self.bits0) - self.vocabulary) / float(until[-1])
            self.low0 = np.zeros(self.vocabulary + 1, np.int32)
            self.low0[1:] = (until * spare).astype(np.int64) + np.arange(1, self.vocabulary + 1)  # no interval is empty
            self.low0[-1] = 1 << self.bits0
            if self.decoding:
                self.id_at = np.repeat(np.arange(self.vocabulary, dtype=np.int32), np.diff(self.low0))
        total = self.outcomes.sum(axis=1, keepdims=True)
        share = self.outcomes * ((1 << _MIX_BITS) - 3) // total + 1
        share[:, _MISS] += (1 << _MIX_BITS) - share.sum(axis=1)
        self.share, self.low = share.ravel(), (np.cumsum(share, axis=1) - share).ravel()
        self.wide_share, self.wide_low = self.share << self.bits0, self.low << self.bits0

    # per lane there is arithmetic on 0 and 1 rather than np.where, which takes ten times as long on values that do not follow each other

    def predict(self, lanes: int) -> None:
        """Both predictions and the mixing context of the first `lanes` lanes."""
        one, two = self.before[0, :lanes], self.before[1, :lanes]
        self.at = [((two * 0x9E3779B1 + one * 0x85EBCA77) >> 7) & ((1 << _CONTEXT_BITS) - 1), one]
        self.guess = [said.take(at, mode="clip") for said, at in zip(self.said, self.at, strict=True)]
        self.id2, self.id1 = self.guess[0] >> _SURE_BITS, self.guess[1] >> _SURE_BITS
        self.trust = [guess.astype(np.int8) & np.int8(_MOST_SURE) for guess in self.guess]
        both = (self.trust[0] << np.int8(_SURE_BITS) | self.trust[1]).astype(np.int64)
        self.mix = (both << 1 | (self.id2 == self.id1)) * 3

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the ids' intervals of 2 ** (_MIX_BITS + bits0), after predict."""
        self.hit = [ids == self.id2, ids == self.id1]
        outcome = (~self.hit[0]).view(np.int8) << (~self.hit[1]).view(np.int8)
        return self._interval(ids, self.mix + outcome, np.flatnonzero(outcome == _MISS))

    def _interval(self, ids: np.ndarray, at: np.ndarray, miss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.outcome = at
        low, length = self.wide_low.take(at, mode="clip"), self.wide_share.take(at, mode="clip")
        missed, part = ids.take(miss, mode="clip"), self.share.take(at.take(miss, mode="clip"), mode="clip")
        start = self.low0.take(missed, mode="clip")
        low[miss] += part * start
        length[miss] = part * (self.low0.take(missed + 1, mode="clip") - start)
        return low, length

    def id_at_place(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold these places, and the intervals, after predict."""
        outcome = (place >= self.wide_low.take(self.mix + 1, mode="clip")).view(np.int8) + (place >= self.wide_low.take(self.mix + _MISS, mode="clip"))
        at, miss = self.mix + outcome, np.flatnonzero(outcome == _MISS)
        ids = self.id1 + (self.id2 - self.id1) * (outcome == 0)
        missed = at.take(miss, mode="clip")
        inside = (place.take(miss, mode="clip") - self.wide_low.take(missed, mode="clip")) // self.share.take(missed, mode="clip")
        ids[miss] = self.id_at.take(inside, mode="clip")
        self.hit = [ids == self.id2, ids == self.id1]
        return ids, *self._interval(ids, at, miss)

    def learn(self, ids: np.ndarray) -> None:
        seen = np.bincount(self.outcome, minlength=self.outcomes.size).reshape(self.outcomes.shape)
        self.outcomes += seen
        heavy = self.outcomes.sum(axis=1) > 4096
        self.outcomes[heavy] = self.outcomes[heavy] + 1 >> 1
        new = ids << _SURE_BITS
        for said, at, guess, trust, hit in zip(self.said, self.at, self.guess, self.trust, self.hit, strict=True):
            # right: surer by one, _MOST_SURE at most; wrong: half as sure, or the new id where it was not sure at all
            less, right = trust - (trust >> np.int8(1)), hit.view(np.int8)
            change = right * (less + (trust < _MOST_SURE)) - less
            # of lanes with one context the last counts, for reader and writer alike
            said[at] = guess + change + (new - guess) * ((trust | right) == 0)
        self.pending.append(ids)
        lanes = len(ids)
        self.before[1, :lanes] = self.before[0, :lanes]
        self.before[0, :lanes] = ids
        self.step += 1
        self.renew()


class _Coder:
    """Carry-less range coder (Subbotin), 64-bit state and 16-bit words, one per lane.

    The words are kept by their number in the lane, then by lane: lanes are about equally far, so the words of a step lie together.
    """

    def __init__(self, lanes: int, words: np.ndarray):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.lanes, self.words, self.place = lanes, words, np.arange(lanes)

    def narrowed(self, lanes: int, low: np.ndarray, length: np.ndarray, unit: np.ndarray) -> None:
        """Narrow the first lanes' ranges and shift out the words that are settled."""
        base, size = self.low[:lanes], self.range[:lanes]
        base += low.view(np.uint64) * unit
        np.multiply(length.view(np.uint64), unit, out=size)
        todo = np.flatnonzero(((base ^ (base + size)) < _TOP) | (size < _BOTTOM))
        while len(todo):
            low, size = self.low.take(todo, mode="clip"), self.range.take(todo, mode="clip")
            cut = np.flatnonzero((low ^ (low + size)) >= _TOP)
            size[cut] = (np.uint64(0) - low[cut]) & (_BOTTOM - np.uint64(1))
            self.shift(todo, low >> np.uint64(48))
            low <<= np.uint64(16)
            size <<= np.uint64(16)
            self.low[todo], self.range[todo] = low, size
            todo = todo[((low ^ (low + size)) < _TOP) | (size < _BOTTOM)]

    def shift(self, lanes: np.ndarray, word: np.ndarray) -> None:
        raise NotImplementedError


class _Writer(_Coder):
    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes, np.zeros(lanes * (steps + 8), np.uint16))

    def shift(self, lanes: np.ndarray, word: np.ndarray) -> None:
        place = self.place.take(lanes, mode="clip")
        if place.max() >= len(self.words):
            self.words = np.concatenate([self.words, np.zeros_like(self.words)])
        self.words[place] = word
        self.place[lanes] = place + self.lanes

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Two more words each name a number inside the lane's range; what follows reads as zeros."""
        low = np.uint64((1 << 32) - 1)
        value = (self.low + low) & ~low
        every = np.arange(self.lanes)
        for shift in (48, 32):
            self.shift(every, (value >> np.uint64(shift)) & np.uint64(0xFFFF))
        count = self.place // self.lanes
        by_lane = np.ascontiguousarray(self.words.reshape(-1, self.lanes).T)
        return by_lane[np.arange(by_lane.shape[1]) < count[:, None]], count


class _Reader(_Coder):
    def __init__(self, words: np.ndarray, count: np.ndarray):
        lanes, most = len(count), int(count.max()) + 4
        by_lane = np.zeros((lanes, most), np.uint16)
        by_lane[np.arange(most) < count[:, None]] = words
        super().__init__(lanes, np.ascontiguousarray(by_lane.T).ravel())
        self.value = np.zeros(lanes, np.uint64)
        for _ in range(4):
            self.shift(np.arange(lanes), None)

    def shift(self, lanes: np.ndarray, word: np.ndarray | None) -> None:
        at = self.place.take(lanes, mode="clip")
        self.value[lanes] = (self.value.take(lanes, mode="clip") << np.uint64(16)) | self.words.take(at, mode="clip")
        self.place[lanes] = at + self.lanes


def _shape(n: int) -> tuple[int, int, int]:
    """Lanes, steps and the length of the last lane for n ids."""
    steps = -(-n // min(LANES, max(1, n // MIN_STEPS)))
    lanes = -(-n // steps)
    return lanes, steps, n - (lanes - 1) * steps


def _compress(ids: np.ndarray) -> bytes:
    lanes, steps, last = _shape(len(ids))
    vocabulary = int(ids.max()) + 1
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, coder = _Model(vocabulary, lanes, decoding=False), _Writer(lanes, steps)
    bits = np.uint64(_MIX_BITS + model.bits0)
    for step in range(steps):
        active = lanes if step < last else lanes - 1
        now = grid[step, :active]
        model.predict(active)
        low, length = model.interval(now)
        coder.narrowed(active, low, length, coder.range[:active] >> bits)
        model.learn(now)
    words, count = coder.finish()
    return struct.pack("<II", lanes, vocabulary) + count.astype("<u4").tobytes() + words.astype("<u2").tobytes()


def _expand(data: memoryview, n: int) -> np.ndarray:
    lanes, vocabulary = struct.unpack_from("<II", data)
    count = np.frombuffer(data, "<u4", lanes, 8).astype(np.int64)
    words = np.frombuffer(data, "<u2", int(count.sum()), 8 + 4 * lanes)
    _, steps, last = _shape(n)
    grid = np.zeros((steps, lanes), np.uint32)
    model, coder = _Model(vocabulary, lanes, decoding=True), _Reader(words, count)
    bits = np.uint64(_MIX_BITS + model.bits0)
    most = np.uint64((1 << int(bits)) - 1)
    for step in range(steps):
        active = lanes if step < last else lanes - 1
        model.predict(active)
        unit = coder.range[:active] >> bits
        place = np.minimum((coder.value[:active] - coder.low[:active]) // unit, most).view(np.int64)
        now, low, length = model.id_at_place(place)
        coder.narrowed(active, low, length, unit)
        model.learn(now)
        grid[step, :active] = now
    return np.ascontiguousarray(grid.T).ravel()[:n]


def encode_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, before: int = 0) -> bytes:
    """One block of whole documents; `before` is the number of ids before it in its file."""
    table = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
    body = table + np.asarray(lengths, "<i8").tobytes() + (_compress(ids) if len(ids) else b"")
    raw = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
    head = (_MAGIC, _VERSION, len(doc_ids), len(ids), before, 0, 0, raw)
    check = zlib.crc32(body, zlib.crc32(_HEADER.pack(*head, 0)))
    return _HEADER.pack(*head, check) + body


def decode_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """doc ids, lengths, ids and ids before of a block; ValueError if it is damaged."""
    if len(data) < _HEADER.size:
        raise ValueError("block is cut short")
    *head, check = _HEADER.unpack_from(data)
    magic, version, docs, n, before, _, _, raw = head
    view = memoryview(data)[_HEADER.size :]
    if magic != _MAGIC or version != _VERSION or zlib.crc32(view, zlib.crc32(_HEADER.pack(*head, 0))) != check:
        raise ValueError("block is damaged")
    numbers = np.frombuffer(view, "<i8", docs)
    missing = np.frombuffer(view, np.uint8, docs, 8 * docs)
    lengths = np.frombuffer(view, "<i8", docs, 9 * docs)
    ids = _expand(view[17 * docs :], n) if n else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != raw:
        raise ValueError("ids do not match their checksum")
    return [None if m else int(d) for d, m in zip(numbers, missing, strict=True)], lengths, ids, before


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int | None = 1, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the ids of all texts in ascending doc_id order (nulls last) as blocks.

    A range of doc_ids is one file, its blocks are rows (file, block, ids, docs, data) of a Parquet
    table, which every store Spark writes to can hold and whose commit survives lost tasks.
    """
    spark = docs.sparkSession
    file = sent(spark, vocabulary_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pid = worker_encoder(file.value, end_id), TaskContext.get().partitionId()
        before = number = held = 0
        doc_ids, lengths, ids = [], [], []

        def block() -> pa.RecordBatch:
            nonlocal before, number, held, doc_ids, lengths, ids
            data = encode_block(doc_ids, np.concatenate(lengths), np.concatenate(ids), before)
            row = pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([len(doc_ids)], pa.int64()), pa.array([data], pa.binary())],
                names=["file", "block", "ids", "docs", "data"],
            )
            before, number, held, doc_ids, lengths, ids = before + held, number + 1, 0, [], [], []
            return row

        for batch in batches:
            for part, found, first in tokenized(batch, encoder):
                names = part.column("doc_id").to_pylist()
                at = 0
                while at < len(names):  # whole documents up to the one that fills the block
                    to = min(len(names), int(np.searchsorted(first, first[at] + block_tokens - held)))
                    doc_ids += names[at:to]
                    lengths.append(np.diff(first[at : to + 1]))
                    ids.append(found[first[at] : first[to]])
                    held += int(first[to] - first[at])
                    at = to
                    if held >= block_tokens:
                        yield block()
        if doc_ids:
            yield block()

    texts = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]  # rows of one doc_id, in any order that reruns keep
    ranged = texts.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranged.mapInArrow(encode, "file int, block long, ids long, docs long, data binary").write.parquet(folder)


def file_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """Ids before each file: one number per file reaches the driver."""
    starts, total = {}, 0
    for file, ids in sorted(map(tuple, spark.read.parquet(folder).groupBy("file").agg(F.sum("ids")).collect())):
        starts[file], total = total, total + ids
    return starts


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents read back from the blocks: doc_id, start (ids before it), n_tokens, ids_crc32 and, if wanted, the ids."""
    starts = file_starts(spark, folder)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("file").to_pylist(), batch.column("data"), strict=True):
                doc_ids, lengths, ids, before = decode_block(data.as_py())
                until = np.concatenate([[0], np.cumsum(lengths)])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(until[:-1].tolist(), until[1:].tolist(), strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(until[:-1] + before + starts[file]), pa.array(lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(until, pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return spark.read.parquet(folder).select("file", "data").mapInArrow(decode, schema)
