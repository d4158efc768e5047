import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracle import compare, connect
from tests.llm.hard_rows import plain
from tillwork.llm import prefix_trie, queries
from tillwork.llm.prefix_trie import build_trie, conversation_trie, members_digest, ordered_turns, share_openings
from tillwork.llm.shared import running_by_key


def sequences(rows):
    held = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in held.items()}


def rebuilt(held):
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = held.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(held):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, digest) of every node."""
    nodes = {}
    for c, turns in held.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        under = [n for n in nodes if n[: len(node)] == node]
        leaf = [n for n in under if not any(m[:-1] == n for m in nodes if m)]
        ends = sorted(c for c in members if len(held[c]) == len(node))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), sum(m[:-1] == node for m in nodes if m), len(leaf),
            sum((len(nodes[n]) - 1) * len(n[-1][1].encode()) for n in under if n), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def answer(spark, rows, folder=None, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema)
    trie = build_trie(*share_openings(ordered_turns(frame)))
    return found(trie)


def found(trie):
    digests = {(r["node1"], r["node2"]): r["ends_sha256"] for r in members_digest(trie.ends).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return sorted(
        ((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_bytes"], digests.get((r["node1"], r["node2"]), none)) for r in trie.nodes.collect()),
        key=repr,
    )


def talk(rng, convs, longest, words=3):
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice("aé\U0001f600")[: rng.randrange(3)] * rng.randrange(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)  # a node's members come in many chunks
    rng = random.Random(seed)
    rows = talk(rng, range(60), 30, 2) + talk(rng, range(200, 330), 4, 2) + [(7, 99, "user", "x")] * 3 + [(401, t, "user", "same") for t in range(100)]
    rng.shuffle(rows)
    assert answer(spark, rows) == brute(rebuilt(sequences(rows)))


@pytest.mark.parametrize("block", [1, 3, 8])
def test_block_length_changes_nothing(spark, block):
    rng = random.Random(3)
    rows = talk(rng, range(40), 20, 2)
    assert found(conversation_trie(spark.createDataFrame(rows, SCHEMA), block)) == brute(sequences(rows))


def test_copies_and_prefixes(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(500) for t in range(10 if c % 3 else 20)] + [(1000, t, "user", f"turn {t}") for t in range(8)]
    assert found(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(sequences(rows))


def test_hard_rows(spark):
    rows = [
        (None, 1, "user", "no id"), (1, None, "user", "null turn"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 3, None, "x" * 300000),
        (-7, 1, "user", "negative"), (6, 1, "", ""), (6, 1, "", ""), (11, 5, "user", "only"), (10, -3, "assistant", "before"), (10, 2, "user", "after"),
    ]
    wide = [r + (1, "x", 5, "y") for r in rows]
    got = answer(spark, wide, schema=SCHEMA + ", depth int, `a.b` string, DIGEST int, node1 string")
    held = sequences(rows)
    want = rebuilt({c: t for c, t in held.items() if c >= 0})
    h = zlib.crc32(b"-7") % 9  # the remainder has the sign of the id: -7 belongs to -5, which is absent
    want[-7] = held[-7][h:]
    assert got == brute(want)
    assert answer(spark, []) == []
    assert answer(spark, [(None, 1, "a", "b")]) == []


def test_turnless_conversations_end_at_the_root(spark):
    # the first of 1's family is absent; its h is 2, so of two turns none is left
    assert zlib.crc32(b"1") % 9 == 2
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b")]
    assert answer(spark, rows) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.integers(0, 2**40)), max_size=60))
def test_running_by_key(spark, rows):
    rows = [(k, i, a, x) for i, (k, a, x) in enumerate(rows)]
    got = running_by_key(spark.createDataFrame(rows, "k long, i long, a long, x long"), "k", ["i"], ["a"], ("x",)).collect()
    sums, marks, want = {}, {}, []
    for k, i, a, x in rows:
        sums[k], marks[k] = sums.get(k, 0) + a, marks.get(k, 0) ^ x
        want.append((k, i, a, x, sums[k], marks[k]))
    assert sorted(map(tuple, got)) == sorted(want)


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op11", queries.QUERIES["op11_prefix_trie"], queries.ORACLES["op11_prefix_trie"])[0] == "same"
