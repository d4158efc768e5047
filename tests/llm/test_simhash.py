import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.hard_rows import documents, plain  # noqa: F401
from tillwork.llm import queries
from tillwork.llm.simhash import choose_references, choose_splits, distances, fingerprint, near_fingerprints, near_links, near_pairs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(marks):
    """The smallest place reachable from each over pairs at most 2 bits apart."""
    root = list(range(len(marks)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                if (a ^ b).bit_count() <= 2 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉé \n\t\x0b\x1f\x85 \U0001f600-", max_size=80), st.integers(1, 20))
def test_fingerprint(text, limit):
    assert fingerprint(text.encode(), limit=limit) == slow_fingerprint(text)


def clustered(rng, centres, each, bits):
    marks = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            mark = centre
            for _ in range(rng.randrange(bits)):
                mark ^= 1 << rng.randrange(64)
            marks.add(mark)
    return sorted(marks)


def test_pivot_table_keeps_every_near_pair():
    rng = random.Random(4)
    marks = np.array(clustered(rng, 30, 30, 5) + [0, 1, 3, 2**63, 2**64 - 1], np.uint64)
    references = choose_references(marks[:200])
    i, j, verified = near_pairs(marks, references, 2)
    want = {(a, b) for a in range(len(marks)) for b in range(a) if int(marks[a] ^ marks[b]).bit_count() <= 2}
    assert {(max(a, b), min(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)
    assert verified < len(marks) * (len(marks) - 1) / 2 / 10  # the table discards most pairs


def test_splits_keep_near_pairs_together():
    rng = random.Random(5)
    marks = np.array(clustered(rng, 100, 20, 6), np.uint64)
    references = choose_references(marks[:300])
    table = distances(marks, references)
    counts = np.stack([np.bincount(table[:, r], minlength=65) for r in range(len(references))])
    splits = choose_splits(counts, 2, 50)
    assert splits and len(references) == len(set(references.tolist())) == 32
    for r, border in splits:
        near, far = table[:, r] <= border, table[:, r] > border - 2
        assert max(near.sum(), far.sum()) < len(marks)
        for a in range(0, len(marks), 7):
            close = np.bitwise_count(marks[a] ^ marks) <= 2
            assert (~close | (near[a] & near) | (far[a] & far)).all()


@pytest.mark.parametrize("cell", [2048, 4])
def test_links_connect_what_chains_connect(spark, cell):
    rng = random.Random(6)
    marks = clustered(rng, 25, 30, 5)
    rng.shuffle(marks)
    signed = [int(np.uint64(m).astype(np.int64)) for m in marks]
    found = near_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), cell=cell).collect()
    at = {s: i for i, s in enumerate(signed)}
    root = slow_components(marks)
    assert all(root[at[r["src"]]] == root[at[r["dst"]]] for r in found)
    group = {s: s for s in signed}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for r in found:
        group[top(r["src"])] = top(r["dst"])
    assert len({top(s) for s in signed}) == len(set(root))


def test_cells_no_reference_splits(spark):
    # a dense ball: all within two bits of one word, far more than a cell holds
    centre = 0x0F0F123456789ABC
    marks = {centre} | {centre ^ (1 << a) for a in range(64)} | {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    rows = [(int(np.uint64(m).astype(np.int64)),) for m in marks]
    found = near_links(spark.createDataFrame(rows, "fingerprint long"), cell=25).collect()
    reach, todo, near = set(), [rows[0][0]], {}
    for r in found:
        near.setdefault(r["src"], []).append(r["dst"])
        near.setdefault(r["dst"], []).append(r["src"])
    while todo:
        x = todo.pop()
        if x not in reach:
            reach.add(x)
            todo += near[x]
    assert len(reach) == len(rows)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("abcdefgh") * 3
    return " ".join(words)


def brute(rows):
    marks = [slow_fingerprint(t) for _, t in rows]
    some = sorted(set(marks))
    root = dict(zip(some, slow_components(some)))
    least = {}
    for (d, _), m in zip(rows, marks):
        if d is not None:
            least[root[m]] = min(d, least.get(root[m], d))
    return sorted(((d, f"{m:016x}", least.get(root[m])) for (d, _), m in zip(rows, marks)), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(500)]
    rows = []
    for _ in range(20):
        words = rng.choices(vocabulary, k=rng.randrange(50, 400))
        rows += [edited(rng, words, rng.randrange(0, 3)) for _ in range(rng.choice([1, 2, 8, 15]))]
    rows = list(enumerate(rows + rows[:30] + ["one", "ONE", "", " ", None, "two words"]))
    rng.shuffle(rows)
    got = near_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), cell=5).collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=repr) == want
    assert any(d != c for d, _, c in want)


def test_hard_rows(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted(map(tuple, near_fingerprints(documents).collect()), key=repr) == brute(rows)
    assert near_fingerprints(documents.limit(0)).count() == 0
    only = near_fingerprints(documents.filter("doc_id IS NULL AND text IS NOT NULL")).collect()
    assert [r["component_id"] for r in only] == [None]


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, folder, "documents").collect()]
    assert sorted(map(tuple, queries.QUERIES["op12_simhash"](spark, folder).collect()), key=repr) == brute(docs)
