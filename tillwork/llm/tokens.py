"""Token ids of whole batches of texts, by the tokenizers library.

Texts repeat their words, so a piece of a word goes through the tokenizer once per worker and the ids of a
text are put together with numpy. That gives the tokenizer's own ids for a tokenizer that never joins across blanks,
such as word_bpe_49k.json, whose pre-tokenizer drops them; texts are cut at ASCII blanks only.
"""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core already

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from tillwork.llm.words import text_slices

PIECES_KEPT = 400_000  # pieces of a generation; a worker remembers two, about 180 MB, and forgets what neither has used

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False  # the ASCII blanks
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:192] = _CLASS[0xC3] = _LETTER
# an apostrophe may bind letters, < may begin a special token, and of the other characters only the
# Latin letters from U+00C0 to U+00FF (lead byte C3) are sure to be letters that do not combine
_ODD = np.zeros(256, bool)
_ODD[192:] = True
_ODD[0xC3] = False
_ODD[[ord("'"), ord("<")]] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_SMALL_AFTER_C3 = np.arange(256, dtype=np.uint8)
_SMALL_AFTER_C3[0x80:0x9F] += 32  # without the sign of multiplication, which is odd
_LETTERS_ONLY = re.compile(r"[a-zß-öø-ÿ]+")
_LETTERS = "".join(c for c in map(chr, range(256)) if _LETTERS_ONLY.fullmatch(c))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str) -> str:
    """The tokenizer's file, read on the driver, which sends it along with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


class Encoder:
    """ids(texts) for one tokenizer file; end_id, if given, follows every text."""

    def __init__(self, vocabulary: str, end_id: int | None = None):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.end_id = end_id
        self.letters = self._letters()
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _letters(self) -> dict[int, str] | None:
        """What the tokenizer makes of each letter before its model sees it; None if a run of letters is not just theirs in turn."""
        def before_model(text: str) -> list[str]:
            normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
            return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)] if self.tokenizer.pre_tokenizer else [normal]

        found = {ord(c): "".join(before_model(c)) for c in _LETTERS}
        return found if all(before_model(run) == [run.translate(found)] for run in (_LETTERS, _LETTERS[::-1])) else None

    def _learn(self, pieces: list[str]) -> None:
        """Runs of letters go straight to the tokenizer's model, as its steps before that only spell them anew; the rest go through all of it."""
        letters = [p for p in pieces if _LETTERS_ONLY.fullmatch(p)] if self.letters else []
        tokenize, ids, stops = self.tokenizer.model.tokenize, [], []
        for piece in letters:
            ids += [token.id for token in tokenize(piece if piece.isascii() else piece.translate(self.letters))]
            stops.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        self.pieces.update(zip(letters, map(raw.__getitem__, map(slice, [0, *stops], stops)), strict=True))
        if len(letters) < len(pieces):
            others = list(set(pieces).difference(letters))
            encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            self.pieces.update({p: np.array(e.ids, "<u4").tobytes() for p, e in zip(others, encoded, strict=True)})

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as bytes and offsets: all ids (uint32) and the texts' offsets in them."""
        strings, first = _pieces(data, offsets)
        coded = pc.dictionary_encode(strings)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.pieces) > PIECES_KEPT:
            self.pieces, self.older = {}, self.pieces
        blobs = list(map(self.pieces.get, distinct))
        unseen = [i for i, blob in enumerate(blobs) if blob is None]
        missing = []
        for i in unseen:
            piece = distinct[i]
            blob = self.older.get(piece)
            if blob is None:
                missing.append(piece)
            else:
                self.pieces[piece] = blob
        if missing:
            self._learn(missing)
        for i in unseen:
            blobs[i] = self.pieces[distinct[i]]
        piece = coded.indices.to_numpy(zero_copy_only=False)
        if self.end_id is not None:  # one more piece at the end of each text
            piece = np.insert(piece, first[1:], len(distinct))
            blobs.append(np.uint32(self.end_id).astype("<u4").tobytes())
            first = first + np.arange(len(first))
        length = np.fromiter(map(len, blobs), np.int32, len(blobs)) // 4
        known = np.frombuffer(b"".join(blobs), "<u4")
        count = length[piece]
        until = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        return _gathered(known, (np.cumsum(length) - length)[piece], count), until[first]


def _gathered(known: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """known[start[0] : start[0] + count[0]], then the next run, and so on, by one running sum of steps."""
    if not count.all():
        start, count = start[count > 0], count[count > 0]
    if not len(count):
        return known[:0]
    at = np.cumsum(count, dtype=np.int64)
    step = np.ones(at[-1], np.int32)
    step[0] = start[0]
    step[at[:-1]] = start[1:] - (start[:-1] + count[:-1] - 1)
    return known.take(np.cumsum(step, dtype=np.int32), mode="clip")


def _looked_up(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] of bytes, without an index of eight bytes for each."""
    return np.frombuffer(bytearray(data).translate(table.tobytes()), table.dtype)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of texts that the tokenizer never joins, and the number of pieces before each text.

    Words between ASCII blanks fall apart into runs of letters, single digits and runs of signs, in lower
    case; a word with an odd character stays whole and as it is.
    """
    solid = _looked_up(data, _SOLID)
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges], ends[edges - 1] = solid[edges], solid[edges - 1]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    word = np.cumsum(length) - length  # starts of the words without the blanks
    packed = data[solid]
    text, new = _looked_up(packed, _SMALL), np.zeros(len(packed), bool)
    if len(packed):
        kind, odd = _looked_up(packed, _CLASS), _looked_up(packed, _ODD)
        after_c3 = np.flatnonzero(packed[:-1] == 0xC3) + 1
        text[after_c3] = _SMALL_AFTER_C3[packed[after_c3]]
        odd[after_c3] |= (packed[after_c3] == 0x97) | (packed[after_c3] == 0xB7)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        odd_word = np.logical_or.reduceat(odd, word)
        if odd_word.any():
            whole = np.repeat(odd_word, length)
            new &= ~whole
            text[whole] = packed[whole]
        new[word] = True
    at = np.flatnonzero(new)
    bounds = np.append(at, len(packed)).astype(np.int64)
    strings = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(text))
    return strings, np.searchsorted(at, np.append(word, len(packed))[np.searchsorted(start, offsets)])


_ENCODERS: dict[tuple[int, int | None], Encoder] = {}


def worker_encoder(vocabulary: str, end_id: int | None) -> Encoder:
    """The worker's encoder for this file, kept between tasks."""
    key = (hash(vocabulary), end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary, end_id)
    return _ENCODERS[key]


def tokenized(batch: pa.RecordBatch, encoder: Encoder):
    """Slices of the batch with the ids of their texts and the texts' offsets in them."""
    for part, data, offsets in text_slices(batch, "text"):
        yield part, *encoder.ids(data, offsets)


def sent(spark: SparkSession, vocabulary_path: str):
    """The tokenizer's file as a broadcast value: a file of a few MB, whatever the data."""
    return spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
