"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads runs of SEGMENT bytes forwards and backwards, gives every position a distribution
over the languages, and a document's distribution is the mean over the positions of its letters. It
is trained here, in numpy, by backpropagation through time on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, plain_names
from tillwork.llm.words import _LOWER, text_slices

HIDDEN = 8  # units per direction
SEGMENT = 256  # bytes read in one run; the state starts anew with each
SAMPLE = 400  # labelled documents per language to learn from: the bound of the training sample
WINDOWS = 4  # runs taken of each
WINDOW = 96  # characters
STEPS, BATCH, RATE = 260, 128, 0.02
UNKNOWN = "und"
_ROWS = 2048  # runs worked on together
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Model:
    languages: list[str]
    read: np.ndarray  # 2 x 256 x 3H: what a byte adds to the gates update, reset and candidate
    turn: np.ndarray  # 2 x H x 3H
    bias: np.ndarray  # 2 x 1 x H: of the candidate's recurrent part
    out: np.ndarray  # 2 x H x languages
    base: np.ndarray  # languages


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _new_model(languages: list[str], hidden: int, rng: np.random.Generator) -> Model:
    def draw(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Model(
        languages, draw(2, 256, 3 * hidden, scale=0.3), draw(2, hidden, 3 * hidden, scale=hidden**-0.5), np.zeros((2, 1, hidden), np.float32),
        draw(2, hidden, len(languages), scale=0.3), np.zeros(len(languages), np.float32),
    )


def gradients(model: Model, text: np.ndarray, weight: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Loss and gradients of one batch: text (rows x bytes), weight of each position, label of each row.

    Both directions run as one, the second on the reversed rows.
    """
    rows, length = text.shape
    hidden = model.turn.shape[1]
    both = np.stack([text, text[:, ::-1]])
    side = np.arange(2)[:, None]
    state = np.zeros((length + 1, 2, rows, hidden), model.read.dtype)
    kept = []
    for t in range(length):
        before = state[t]
        given, own = model.read[side, both[:, :, t]], before @ model.turn
        gate = _sigmoid(given[..., : 2 * hidden] + own[..., : 2 * hidden])
        update, reset = gate[..., :hidden], gate[..., hidden:]
        inner = own[..., 2 * hidden :] + model.bias
        candidate = np.tanh(given[..., 2 * hidden :] + reset * inner)
        state[t + 1] = candidate + update * (before - candidate)
        kept.append((update, reset, inner, candidate))
    forward, backward = state[1:, 0], state[:0:-1, 1]  # both by position
    chance = _softmax(forward @ model.out[0] + backward @ model.out[1] + model.base)  # length x rows x languages
    share = (weight / weight.sum()).T[..., None].astype(chance.dtype)
    picked = chance[:, np.arange(rows), label]
    loss = float(-(np.log(picked + 1e-12) * share[..., 0]).sum())
    error = chance.copy()
    error[:, np.arange(rows), label] -= 1
    error *= share
    grads = {k: np.zeros_like(getattr(model, k)) for k in ("read", "turn", "bias", "out", "base")}
    grads["base"] = error.sum(axis=(0, 1))
    grads["out"][0] = np.einsum("trh,trl->hl", forward, error)
    grads["out"][1] = np.einsum("trh,trl->hl", backward, error)
    above = np.stack([error @ model.out[0].T, (error @ model.out[1].T)[::-1]], axis=1)  # by step of each direction
    later = np.zeros((2, rows, hidden), model.read.dtype)
    for t in range(length - 1, -1, -1):
        update, reset, inner, candidate = kept[t]
        before, now = state[t], later + above[t]
        to_candidate = now * (1 - update) * (1 - candidate**2)
        to_update = now * (before - candidate) * update * (1 - update)
        to_inner = to_candidate * reset
        to_reset = to_candidate * inner * reset * (1 - reset)
        to_own = np.concatenate([to_update, to_reset, to_inner], axis=2)
        to_given = np.concatenate([to_update, to_reset, to_candidate], axis=2)
        grads["turn"] += before.transpose(0, 2, 1) @ to_own
        grads["bias"] += to_inner.sum(axis=1, keepdims=True)
        for d in range(2):
            np.add.at(grads["read"][d], both[d, :, t], to_given[d])
        later = now * update + to_own @ model.turn.transpose(0, 2, 1)
    return loss, grads


def train(samples: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 7) -> Model | None:
    """A model from (language, bytes of a run) pairs, each language drawn equally often; None without any."""
    samples = sorted((lang, bytes(_LOWER[np.frombuffer(raw, np.uint8)])) for lang, raw in samples if raw)
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    model = _new_model(languages, hidden, rng)
    length = max(len(raw) for _, raw in samples)
    text = np.full((len(samples), length), 32, np.uint8)
    for i, (_, raw) in enumerate(samples):
        text[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    weight = _LETTER[text] + np.float32(1e-3)
    of = [np.flatnonzero([lang == x for x, _ in samples]) for lang in languages]
    mean, square = {}, {}
    for step in range(1, steps + 1):
        label = rng.integers(0, len(languages), batch)
        row = np.array([rng.choice(of[x]) for x in label])
        _, grads = gradients(model, text[row], weight[row], label)
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        for k, g in grads.items():  # Adam on clipped gradients
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            mean[k] = 0.9 * mean.get(k, 0) + 0.1 * g
            square[k] = 0.99 * square.get(k, 0) + 0.01 * g**2
            change = pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
            setattr(model, k, (getattr(model, k) - change).astype(np.float32))
    return model


def _pass(model: Model, side: int, steps: np.ndarray, live: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """What one direction adds to the languages' logits, step by step; arrays are units x rows.

    live, if given, is 0 where a row has no byte: there its state stays at the start.
    """
    hidden = model.turn.shape[1]
    half = np.concatenate([np.full(2 * hidden, 0.5), np.ones(hidden)]).astype(np.float32)  # sigmoid(x) = (1 + tanh(x / 2)) / 2
    read = np.ascontiguousarray(model.read[side] * half)
    turn = np.ascontiguousarray((model.turn[side] * half).T)
    bias, out = model.bias[side].T, np.ascontiguousarray(model.out[side].T)
    rows = steps.shape[1]
    state, own = np.zeros((hidden, rows), np.float32), np.empty((3 * hidden, rows), np.float32)
    for t, byte in enumerate(steps):
        given = np.ascontiguousarray(np.take(read, byte, axis=0).T)
        np.matmul(turn, state, out=own)
        gate = own[: 2 * hidden]
        gate += given[: 2 * hidden]
        np.tanh(gate, out=gate)
        gate *= 0.5
        gate += 0.5
        inner, candidate = own[2 * hidden :], given[2 * hidden :]
        inner += bias
        inner *= gate[hidden:]
        candidate += inner
        np.tanh(candidate, out=candidate)
        state -= candidate
        state *= gate[:hidden]
        state += candidate
        if live is not None:
            state *= live[t]
        yield out @ state


def run_chances(model: Model, runs: np.ndarray, length: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Position and chances (languages x runs), last position first, of runs (rows x bytes) of these lengths (else full)."""
    columns = np.ascontiguousarray(runs.T)
    live = None
    if length is not None and length.min() < len(columns):
        live = (np.arange(len(columns))[::-1, None] < length).astype(np.float32)
    ahead = list(_pass(model, 0, columns))
    for t, back in zip(range(len(columns) - 1, -1, -1), _pass(model, 1, columns[::-1], live), strict=True):
        logits = ahead[t]
        logits += back
        logits += model.base[:, None]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        yield t, logits


def _runs(data: np.ndarray, offsets: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the runs the texts are cut into."""
    count = -(-np.diff(offsets) // segment)
    doc = np.repeat(np.arange(len(count)), count)
    start = offsets[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * segment
    return doc, start, np.minimum(segment, offsets[doc + 1] - start)


def document_chances(model: Model, data: np.ndarray, offsets: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Mean distribution (documents x languages) over the positions of letters; zeros without any."""
    low = _LOWER[data]
    doc, start, length = _runs(data, offsets, segment)
    sums = np.zeros((len(offsets) - 1, len(model.languages)))
    letters = np.zeros(len(offsets) - 1)
    order = np.argsort(length, kind="stable")  # runs of about one length together
    for at in range(0, len(order), _ROWS):
        mine = order[at : at + _ROWS]
        long = int(length[mine].max())
        place = start[mine, None] + np.arange(long)
        runs = np.where(np.arange(long) < length[mine, None], low[np.minimum(place, len(low) - 1)], 32).astype(np.uint8)
        counted = np.ascontiguousarray(_LETTER[runs].T.astype(np.float32))
        total = np.zeros((len(model.languages), len(mine)), np.float32)
        for t, chance in run_chances(model, runs, length[mine]):
            chance *= counted[t]
            total += chance
        np.add.at(sums, doc[mine], total.T)
        np.add.at(letters, doc[mine], counted.sum(axis=0))
    return sums / np.maximum(letters, 1)[:, None]


def label_positions(model: Model, text: str, segment: int = SEGMENT) -> list[tuple[int, int, str]]:
    """Runs (first byte, end byte, language) of equal labels over all positions of one text."""
    data = np.frombuffer(text.encode(), np.uint8)
    _, start, length = _runs(data, np.array([0, len(data)]), segment)
    label = np.zeros(len(data), int)
    for s, n in zip(start, length, strict=True):
        for t, chance in run_chances(model, _LOWER[data[None, s : s + n]]):
            label[s + t] = chance[:, 0].argmax()
    edges = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(data)] if len(data) else []
    return [(a, b, model.languages[label[a]]) for a, b in zip(edges, edges[1:], strict=False)]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of doc_id as text, modulo 4, is 2; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE, **training) -> Model | None:
    """Train on about `sample` documents per language that are not held out and have a lang and a text.

    Documents are chosen by a hash of doc_id, at a rate taken from counts of all rows; the driver
    gets WINDOWS runs of WINDOW characters of each and trains there. None if there is no label.
    """
    rows = narrow(docs, "doc_id", "text", "lang").filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    rate = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, sample / n))])[F.col("lang")]
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    window = F.explode(F.sequence(F.lit(0), F.lit(WINDOWS - 1)))
    begin = F.pmod(F.xxhash64("doc_id", "k"), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1).cast("int")
    taken = chosen.withColumn("k", window).select("lang", F.substring(F.col("text"), begin + 1, F.lit(WINDOW)).alias("run"))
    return train([(r["lang"], r["run"].encode()) for r in taken.distinct().collect()], **training)


def _judged(model: Model | None, data: np.ndarray, offsets: np.ndarray, segment: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text, and whether it has a letter."""
    n = len(offsets) - 1
    named, score = [UNKNOWN] * n, np.zeros(n)
    ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[_LOWER[data]] & (data < 128))])
    lettered = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
        lettered[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    if model is not None and len(data):
        chances = document_chances(model, data, offsets, segment)
        best = chances.argmax(axis=1)
        for i in np.flatnonzero(lettered):
            named[i], score[i] = model.languages[best[i]], min(1.0, float(chances[i, best[i]]))
    return named, score, lettered


def identify(docs: DataFrame, model: Model | None, segment: int = SEGMENT) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its whole text alone.

    lang_pred is und, with score 0, if the text is null or has no letter, or if there is no model;
    else the language of the largest mean chance, the first by name of equals; score is that chance.
    Repeated rows and rows with a null doc_id are judged like others. Empty in, empty out.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                named, score, _ = _judged(model, data, offsets, segment)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(named, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return narrow(docs, "doc_id", "text").mapInArrow(judge, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model | None, min_score: float, segment: int = SEGMENT) -> DataFrame:
    """The documents with a recognised language and a score of at least min_score, with all their columns.

    Without a model those with a letter. The text is the column of that exact name.
    """
    named = plain_names(docs, "text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                _, score, lettered = _judged(model, data, offsets, segment)
                yield part.filter(pa.array(lettered & (score >= min_score) if model is not None else lettered))

    return named.mapInArrow(choose, named.schema).toDF(*docs.columns)
