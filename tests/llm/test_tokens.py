import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm import token_codec
from tillwork.llm.packing import fullest, pack, pack_documents
from tillwork.llm.token_codec import decode_block, encode_block, file_starts, read_tokens, write_tokens
from tillwork.llm.tokens import Encoder, default_vocabulary, read_vocabulary, tokenized

FILE = default_vocabulary()
ENCODER = Encoder(read_vocabulary(FILE), 1)
TOKENIZER = Tokenizer.from_file(FILE)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def ours(texts):
    out = []
    for _, ids, first in tokenized(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]), ENCODER):
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


HARD = [
    None, "", " ", "a", "it's IT'S don't'll", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "x</w>y </w>", "ﬁ ß ẞ İ İ é É Ångström Å Ķ",
    "a\x1fb\x1cc\x85d\xa0e f\tg\r\nh\x0bi\x0cj", "12 3.5 1,000 ½ ² Ⅷ", "日本語 한국어 العربية", "😀😀 a😀b", "Ertzßsch öäü ÖÄÜ ×÷ ªº µ", "$$$ %%% &&&*** ''' '", "a" * 5000, "ΑΣ Σ ς", "﻿bom", "`x` ~y~ [z] {w} @q ^r _s_",
]


def test_ids_are_the_tokenizers():
    assert ours(HARD) == [ids_of(t) for t in HARD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abzAZ'<|>/ew \n\t0é́ßÿ$."), st.characters(exclude_categories=["Cs"])), max_size=25), max_size=5))
def test_ids_of_any_text(texts):
    assert ours(texts) == [ids_of(t) for t in texts]


def test_real_texts(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert ours(texts) == [ids_of(t) for t in texts]


class _ModelOnly:
    """A tokenizer of which only the model may be used."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model


def test_letters_go_straight_to_the_model():
    words = "straße Ärger niño ça où ÿ the THE zebra"
    encoder = Encoder(read_vocabulary(FILE), 1)
    encoder.tokenizer = _ModelOnly(encoder.tokenizer)
    data = words.encode()
    ids, first = encoder.ids(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert ids.tolist() == ids_of(words) and first.tolist() == [0, len(ids)]


def test_a_tokenizer_that_cuts_runs_of_letters_is_used_whole():
    other = json.loads(read_vocabulary(FILE))
    other["pre_tokenizer"]["pretokenizers"][0] = {"type": "Split", "pattern": {"Regex": "[\\p{L}][\\p{L}]?|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
    encoder, data = Encoder(json.dumps(other)), "seven words über zwölf".encode()
    assert encoder.letters is None
    ids, _ = encoder.ids(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert ids.tolist() == Tokenizer.from_str(json.dumps(other)).encode(data.decode(), add_special_tokens=False).ids


def test_fullest_is_best():
    rng = np.random.default_rng(1)
    for _ in range(200):
        room = int(rng.integers(0, 40))
        left = {int(n): int(rng.integers(1, 4)) for n in rng.integers(1, 30, 5)}
        sums = {0}
        for n, copies in left.items():
            sums = {s + n * c for s in sums for c in range(copies + 1)}
        chosen = fullest(room, sorted(left), left)
        assert sum(chosen) == max(s for s in sums if s <= room)
        assert all(chosen.count(n) <= left[n] for n in chosen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_pack(sizes):
    at, offset = pack(np.array(sizes, np.int64), 50)
    bins = {}
    for size, b, o in zip(sizes, at.tolist(), offset.tolist(), strict=True):
        bins.setdefault(b, []).append((o, size))
    for pieces in bins.values():
        end = 0
        for o, size in sorted(pieces):
            assert o == end
            end += size
        assert end <= 50
    if sizes:
        assert len(bins) <= 1 + 11 * -(-sum(sizes) // 50) // 9 + 1


def check_packing(docs, rows, capacity):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(ids_of(r["text"]))
    want = sorted(
        (str(d), p, zlib.crc32(np.array(ids[s : s + capacity], "<u4").tobytes()), s, len(ids[s : s + capacity]))
        for d, many in texts.items() for ids in many for p, s in enumerate(range(0, len(ids), capacity))
    )
    assert sorted((str(r["doc_id"]), r["piece"], r["ids_crc32"], r["start"], r["length"]) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        assert [o for o, _ in sorted(pieces)] == [sum(n for _, n in sorted(pieces)[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= capacity
    return len(bins), sum(r["length"] for r in rows)


def test_hard_documents_packed(spark, documents):
    check_packing(documents, plain(pack_documents(documents, FILE)), 4096)
    check_packing(documents, plain(pack_documents(documents, FILE, capacity=16, group=5)), 16)
    assert pack_documents(documents.limit(0), FILE).count() == 0


def test_sequences_are_full(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bins, total = check_packing(docs, plain(pack_documents(docs, FILE)), 4096)
    assert bins <= -(-total // 4096) + 1


def runs(rng, n):
    return {
        "empty": np.zeros(0), "one": np.array([7]), "zeros": np.zeros(n), "random": rng.integers(0, 65_000, n), "text": np.array((ids_of("the quick brown fox ") * n)[:n]),
        "ramp": np.arange(n) % 50_000, "skewed": np.minimum(rng.zipf(1.3, n), 60_000), "large": rng.integers(2**21, 2**21 + 9, 3) if n < 100 else rng.integers(0, 3, n),
    }


@pytest.mark.parametrize("n", [2, 63, 64, 129, 5000, 300_000])
def test_blocks_round_trip(n):
    for name, ids in runs(np.random.default_rng(n), n).items():
        if name == "large":
            ids = ids % 100_000
        ids = ids.astype(np.uint32)
        cut = len(ids) // 3
        data = encode_block([5, None], np.array([cut, len(ids) - cut]), ids, 77)
        docs, lengths, back, before = decode_block(data)
        assert docs == [5, None] and lengths.tolist() == [cut, len(ids) - cut] and before == 77, name
        assert back.tolist() == ids.tolist(), name
        if name == "text" and n > 1000:
            assert len(data) < n  # four repeated words take little


def test_stored_blocks_stay_readable():
    ids = (np.arange(90_000, dtype=np.uint64) ** 2 * 2654435761 >> 19 & 8191).astype(np.uint32) % 5000
    ids[::3] = 77
    assert zlib.crc32(token_codec._compress(ids)) == 4254730335 and token_codec._VERSION == 2


def test_damage_is_found():
    data = bytearray(encode_block([1], np.array([500]), np.arange(500, dtype=np.uint32)))
    for at in (0, 6, 30, 60, len(data) - 1):
        bad = data.copy()
        bad[at] ^= 4
        with pytest.raises(ValueError):
            decode_block(bytes(bad))
    for short in (0, 10, len(data) - 1):
        with pytest.raises(ValueError):
            decode_block(bytes(data[:short]))


@pytest.mark.parametrize("block", [1 << 21, 300])
def test_files_round_trip(spark, documents, tmp_path, block):
    folder = str(tmp_path / "tokens")
    write_tokens(documents, folder, FILE, block_tokens=block)
    rows = sorted((r.asDict() for r in read_tokens(spark, folder).collect()), key=lambda r: r["start"])
    texts = sorted(((r["doc_id"], zlib.crc32((r["text"] or "").encode()), r["text"]) for r in documents.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
    start = 0
    for row, (doc_id, _, text) in zip(rows, texts, strict=True):
        ids = ids_of(text)
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids"]) == (doc_id, start, len(ids), ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert sorted(file_starts(spark, folder).values())[0] == 0


def test_no_documents(spark, documents, tmp_path):
    write_tokens(documents.limit(0), str(tmp_path / "none"), FILE)
    assert read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_model_is_shared_by_reader_and_writer():
    ids = np.random.default_rng(0).integers(0, 40, 20_000).astype(np.uint32)
    assert len(token_codec._compress(ids)) * 8 / len(ids) < 8  # about log2(40) bits and the lanes' ends
