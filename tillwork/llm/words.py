"""Words and word n-grams of whole batches of texts, as numpy arrays over their UTF-8 bytes.

A word is a run of letters a-z, digits and non-ASCII characters, with A-Z lower-cased: the pattern
[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ on the text with only A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.llm.shared import mix64

BATCH_BYTES = 2 << 20  # texts are worked on in slices of about this size (a longer text alone)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of some texts: byte places, and for each text its range of words."""

    data: np.ndarray  # bytes, A-Z lower-cased
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # text i has the words first[i] up to first[i + 1]

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def text_slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bytes of their texts and the texts' offsets; null texts are empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = _LOWER[data]
    inside = _IN_WORD[low]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(inside):
        before[0] = after[-1] = False
        before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(low, start, end, np.searchsorted(start, offsets))


def has_word(text: Column) -> Column:
    """Whether a text has a word; false for null."""
    return F.coalesce(text.rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), F.lit(False))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of every word, a polynomial over its bytes."""
    out = np.empty(len(words.start), np.uint64)
    for lo, hi in _runs(words):
        base = words.start[lo]
        span = words.data[base : words.end[hi - 1]]
        begin = words.start[lo:hi] - base
        length = np.diff(np.append(begin, len(span)))
        power = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
        place = np.arange(len(span)) - np.repeat(begin, length)
        value = np.where(_IN_WORD[span], span, 0).astype(np.uint64) * power[place]
        out[lo:hi] = mix64(np.add.reduceat(value, begin))
    return out


def _runs(words: Words, limit: int = BATCH_BYTES // 4) -> Iterator[tuple[int, int]]:
    at, n = 0, len(words.start)
    while at < n:
        to = max(at + 1, int(np.searchsorted(words.end, words.start[at] + limit, "right")))
        yield at, to
        at = to


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's runs of `width` words and their offsets by text.

    A text of fewer words has one shingle, all of them; a text without words has none.
    """
    count = np.diff(first)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(offsets[-1]) + np.repeat(first[:-1] - offsets[:-1], made)
    stop = np.repeat(first[1:], made)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        out = mix64(out + np.where(at + k < stop, padded[at + k], np.uint64(k + 1)))
    return out, offsets
