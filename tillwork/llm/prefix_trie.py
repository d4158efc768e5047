"""Prefix trie of conversations by fixed-length block hashing.

A turn is a digest of its role and text; a block is BLOCK successive turns, and its digest the exclusive or of hashes of its turns
with their depths. Conversations are grouped by their successive block digests first: one aggregation of a row per
conversation and block, whatever the number of copies. Turn boundaries are refined only where the blocks that follow the same
prefix differ; there the distinct blocks, no longer the conversations, are grouped by turn prefix. A block without
siblings gives its turns' nodes as it stands.

Sums over subtrees are made the same way. A node belongs to its smallest member, so what a conversation owns is the end of its
path, and a running sum from its end backwards gives every block of its path what it owns from there on;
no level of the trie is a job of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.shared import narrow, partitions, running_by_key, running_total, saved
from tillwork.operators.keyed import with_group_totals

BLOCK = 8  # turns of a block
CHUNK = 4096  # members of a node in one row on their way to a digest

_ID = ["node1", "node2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), digest, n_bytes (of the text) and the turn, role and text marks of every turn, as a saved table without texts.

    Turns go by turn, nulls first, those of equal number by role, then text; null roles and texts are empty, repeated rows are
    turns of their own. Rows without a conv_id take no part. A conversation's turns may lie in many tasks.
    """
    rows = narrow(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest")
    slim = saved(rows.select("conv_id", "turn", digest, F.octet_length("text").cast("long").alias("n_bytes")), "turns")
    mark = F.xxhash64("digest")
    tied = slim.groupBy("conv_id", "turn").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).filter("a <> b")
    tied = saved(tied.select(F.col("conv_id").alias("tied_id"), F.col("turn").alias("tied_turn")), "tied")
    same = (F.col("conv_id") == F.col("tied_id")) & F.col("turn").eqNullSafe(F.col("tied_turn"))
    plain = slim.withColumn("tie", F.lit(0).cast("long"))
    if not tied.isEmpty():  # only those turns are put in order by their texts
        known = F.col("turn").isNotNull().cast("int").alias("known")
        texts = rows.join(tied, same, "left_semi").select("conv_id", "turn", known, "role", "text", digest, F.octet_length("text").cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("one"))
        placed = running_total(texts, ["conv_id", "known", "turn", "role", "text"], ["one"])
        plain = plain.join(tied, same, "left_anti").union(placed.select("conv_id", "turn", "digest", "n_bytes", F.col("before_one").alias("tie")))
    known = F.col("turn").isNotNull().cast("int").alias("known")
    number = F.coalesce("turn", F.lit(0)).alias("number")
    keyed = plain.select("conv_id", known, number, "tie", "digest", "n_bytes", F.lit(1).cast("long").alias("one"))
    placed = running_by_key(keyed, "conv_id", ["known", "number", "tie", "digest"], ["one"])
    return placed.select("conv_id", F.col("until_one").alias("depth"), "digest", "n_bytes")


def share_openings(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation c is rebuilt from the opening of its family's first.

    It gets the first h turns of conversation c - c % family (all if fewer, none if absent), then its own after its first h;
    h is the unsigned CRC-32 of c in decimal, modulo most + 1. The remainder has the sign of c, as in SQL.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("held"))
    first = F.col("conv_id") - F.col("conv_id") % family
    convs = saved(convs.select("conv_id", "held", first.alias("first_id"), (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h")), "convs")
    lengths = convs.filter("conv_id = first_id").select(F.col("conv_id").alias("first_id"), F.col("held").alias("opening"))
    plan = convs.join(lengths, "first_id", "left").select("conv_id", "first_id", "h", F.least("h", F.coalesce("opening", F.lit(0))).alias("taken"))
    plan = saved(plan, "plan")
    own = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").filter("depth > h")
    own = own.select("conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_bytes")
    openings = turns.filter((F.col("depth") <= most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "first_id")
    openings = openings.join(plan.select("conv_id", "first_id", "h"), "first_id").filter("depth <= h").select(*own.columns)
    return own.union(openings), plan.select("conv_id")


@dataclass
class Trie:
    """nodes: node1, node2 (its id; the root's is 0, 0), depth, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_bytes; ends: conv_id and the id of the node where it ends."""

    nodes: DataFrame
    ends: DataFrame


def _chained(turns: DataFrame, block: int) -> DataFrame:
    """A row per conversation and block: its turns and the ids of the prefixes before (p) and with it (q)."""
    hashes = [F.xxhash64(F.lit(seed), "depth", "digest").alias(f"z{seed}") for seed in (1, 2)]
    number = F.expr(f"(depth - 1) div {block}").alias("block")
    rows = turns.select("conv_id", number, "depth", "n_bytes", *hashes)
    blocks = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("depth", "z1", "z2", "n_bytes"))).alias("turns"), F.bit_xor("z1").alias("q1"), F.bit_xor("z2").alias("q2")
    )
    return running_by_key(blocks, "conv_id", ["block"], [], ("q1", "q2")).select(
        "conv_id", "block", "turns", F.col("until_q1").alias("q1"), F.col("until_q2").alias("q2"),
        F.col("until_q1").bitwiseXOR(F.col("q1")).alias("p1"), F.col("until_q2").bitwiseXOR(F.col("q2")).alias("p2"),
    )


def _steps(blocks: DataFrame) -> DataFrame:
    """A row per distinct block and turn: the node id (r) with that turn and the id before it (o)."""

    def until(z: str, steps: Column) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), steps), F.col(z.replace("z", "p")), lambda a, t: a.bitwiseXOR(t[z]))

    listed = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.struct(
            i.alias("step"), F.element_at("turns", i)["depth"].alias("depth"), F.element_at("turns", i)["n_bytes"].alias("n_bytes"),
            until("z1", i).alias("r1"), until("z2", i).alias("r2"), until("z1", i - 1).alias("o1"), until("z2", i - 1).alias("o2"),
        ),
    )
    return blocks.select("q1", "q2", "conv_id", "n_convs", "siblings", F.inline(listed))


def build_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> Trie:
    """The trie of the conversations `convs` (conv_id, each once) with the given turns (conv_id, depth from 1 without gaps, digest, n_bytes).

    A node is a distinct sequence of first turns, from the root without a turn; its members are the conversations that start
    with it, also the root's without turns. n_children counts its children, n_leaves the childless nodes of its subtree, itself
    included, and saved_bytes sums (n_convs - 1) * n_bytes of the last turn over the subtree. Without
    conversations there are no nodes. Sequences are told apart by 128-bit hashes.
    """
    chained = saved(_chained(turns, block), "chained")
    blocks = chained.groupBy("q1", "q2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.first("turns").alias("turns")
    )
    blocks = saved(with_group_totals(saved(blocks, "blocks"), ["p1", "p2"], {"siblings": ("count", F.lit(1))}), "blocks")
    steps = saved(_steps(blocks), "steps")
    alone = steps.filter("siblings = 1").select("r1", "r2", "depth", "o1", "o2", "n_bytes", "conv_id", "n_convs")
    refined = steps.filter("siblings > 1").groupBy("r1", "r2").agg(
        *[F.min(c).alias(c) for c in ("depth", "o1", "o2", "n_bytes", "conv_id")], F.sum("n_convs").alias("n_convs")
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        zero.alias("r1"), zero.alias("r2"), zero.alias("depth"), F.lit(None).cast("long").alias("o1"), F.lit(None).cast("long").alias("o2"), zero.alias("n_bytes"), "conv_id", "n_convs"
    )
    nodes = saved(alone.union(refined).union(root), "nodes")
    children = nodes.filter("o1 IS NOT NULL").groupBy(F.col("o1").alias("r1"), F.col("o2").alias("r2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("r1").alias("o1"), F.col("r2").alias("o2"), F.col("conv_id").alias("parent_conv_id"))
    shaped = nodes.join(parents, ["o1", "o2"], "left").join(children, ["r1", "r2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    shaped = saved(shaped.withColumns({"saved": (F.col("n_convs") - 1) * F.col("n_bytes"), "leaf": (F.col("n_children") == 0).cast("long")}), "shaped")

    # what a block's owner has from each of its turns on, within the block
    worth = shaped.select("r1", "r2", F.col("conv_id").alias("owner"), "saved", "leaf")
    mine = F.col("owner") == F.col("conv_id")
    own = steps.select("q1", "q2", "step", "conv_id", "r1", "r2").join(worth, ["r1", "r2"])
    onward = Window.partitionBy("q1", "q2").orderBy(F.desc("step"))
    inside = saved(own.select("q1", "q2", "step", "conv_id", "r1", "r2", *[F.sum(F.when(mine, F.col(c)).otherwise(zero)).over(onward).alias(c) for c in ("saved", "leaf")]), "inside")
    whole = inside.filter("step = 1").select("q1", "q2", F.col("conv_id").alias("owner"), "saved", "leaf")
    # what lies below a block: every owning conversation gives each block of its path what it owns from there on
    owners = blocks.select("conv_id").distinct()
    paths = chained.select("conv_id", (-F.col("block")).alias("back"), "q1", "q2").join(owners, "conv_id", "left_semi").join(whole, ["q1", "q2"])
    paths = paths.select("conv_id", "back", "q1", "q2", *[F.when(mine, F.col(c)).otherwise(zero).alias(c) for c in ("saved", "leaf")])
    paths = running_by_key(paths, "conv_id", ["back"], ["saved", "leaf"])
    below = paths.groupBy("q1", "q2").agg(F.sum("until_saved").alias("all_saved"), F.sum("until_leaf").alias("all_leaf")).join(whole, ["q1", "q2"])
    below = below.select("q1", "q2", (F.col("all_saved") - F.col("saved")).alias("below_saved"), (F.col("all_leaf") - F.col("leaf")).alias("below_leaf"))
    sums = inside.join(below, ["q1", "q2"]).groupBy("r1", "r2").agg(
        F.sum(F.col("leaf") + F.col("below_leaf")).alias("n_leaves"), F.sum(F.col("saved") + F.col("below_saved")).alias("saved_bytes")
    )
    of_root = shaped.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_bytes")).select(zero.alias("r1"), zero.alias("r2"), "n_leaves", "saved_bytes")
    full = shaped.join(sums.union(of_root), ["r1", "r2"]).select(
        F.col("r1").alias("node1"), F.col("r2").alias("node2"), "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes"
    )
    last = chained.groupBy("conv_id").agg(F.max_by("q1", "block").alias("node1"), F.max_by("q2", "block").alias("node2"))
    ends = convs.select("conv_id").join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in _ID])
    return Trie(full, ends)


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> Trie:
    """The trie of conversations (conv_id, turn, role, text) as they are; see ordered_turns and build_trie."""
    turns = ordered_turns(conversations)
    return build_trie(turns, turns.select("conv_id").distinct(), block)


def members_digest(ends: DataFrame) -> DataFrame:
    """node1, node2 and the lowercase SHA-256 of the conv_ids that end at each node, ascending in decimal and comma-joined.

    The ids are sorted over all tasks, which write them in chunks; a node's chunks are hashed as a stream, never held together.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            one, two, ids = (batch.column(c).to_numpy() for c in (*_ID, "conv_id"))
            new = np.ones(n, bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            start = np.flatnonzero(new)
            stop = np.append(start[1:], n)
            start = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(start, stop, strict=True)])
            stop = np.append(start[1:], n)
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(start, stop, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(one[start]), pa.array(two[start]), pa.array(ids[start]), pa.array(texts)], names=[*_ID, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for one, two, ids in zip(*(batch.column(c).to_pylist() for c in (*_ID, "ids")), strict=True):
                if (one, two) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (one, two), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*_ID, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=[*_ID, "ends_sha256"])

    count, order = partitions(ends.sparkSession), [*_ID, "conv_id"]
    ranged = ends.select(*order).repartitionByRange(count, *order).sortWithinPartitions(*order)
    chunks = ranged.mapInArrow(pack, "node1 long, node2 long, first long, ids string")
    by_node = chunks.repartition(count, *_ID).sortWithinPartitions(*_ID, "first")
    return by_node.mapInArrow(digest, "node1 long, node2 long, ends_sha256 string")
