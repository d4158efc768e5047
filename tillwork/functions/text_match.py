"""Token-set name matching without a cross join.

Two names match when their token-set ratio, rounded, is above 82. With t0 the shared tokens
and t1 / t2 the full token strings (t0 first), the score is the best of ratio(t0, t1),
ratio(t0, t2) and ratio(t1, t2), ratio being 100 * (1 - indel distance / total length).

Candidates come from equi-joins that lose no match (limit 82.5 before rounding), and are checked before any score:

* t0 is a prefix of t1 and t2, so the first two ratios need lengths only. ratio(t0, t1) >= 82.5 leaves at most
  (1 - 82.5/117.5) of t1's characters uncovered, so of t1's tokens taken rarest first, the ones that first exceed that
  share contain a shared one; they are joined with all tokens of the other name. Likewise for t2.
* ratio(t1, t2) >= 82.5 means an indel distance d <= 0.175 * S for total length S, d even or odd as S is. The
  space-padded names have (S + 2) letter pairs together, each deletion destroys at most two
  and each insertion one, so at least need(S) = S/2 + 1 - 1.5 d pairs are common; as the lengths differ by
  at most d, S >= 1.702 L for either length L. Taken rarest first in one global order, the leading
  L + 1 - ceil(0.4042 L) pairs of both names therefore share one (prefix). A shared pair with i and j pairs before
  it and k and l behind it allows min(i, j) + 1 + min(k, l) common ones at most (position). The common pairs of
  what is left are counted, and pairs of names below need(S) dropped (count). As the longer name is at
  most 117.5 / 82.5 times as long, only neighbouring classes of length are joined.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tillwork.session import scratch_folder

THRESHOLD = 82
_MIN_RATIO = THRESHOLD + 0.5
_UNCOVERED = 1 - _MIN_RATIO / (200 - _MIN_RATIO)
_MAX_INDEL = 1 - _MIN_RATIO / 100
_SHARED_PAIRS = (0.5 - 1.5 * _MAX_INDEL) * (1 + _MIN_RATIO / (200 - _MIN_RATIO))
_LONGER = (200 - _MIN_RATIO) / _MIN_RATIO
_SLACK = 1e-9
_CELLS = 1 << 22  # letters compared with letters in one step of a batch


def name_tokens(name: Column) -> Column:
    """Sorted distinct lower-case alphanumeric tokens."""
    words = F.split(F.regexp_replace(F.lower(name), r"(?U)[^\p{Alnum}]+", " "), " ")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def _letters(texts: np.ndarray) -> np.ndarray:
    """A row of code points per text, filled up with 0."""
    fixed = np.asarray(texts, dtype=str)
    return fixed.view(np.uint32).reshape(len(fixed), fixed.dtype.itemsize // 4)


def common_lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of many pairs of texts at once.

    A pair's row of the usual table is a string of bits, and a letter of the right text changes it by one addition;
    all pairs of a step go together, letter by letter. Texts hold no NUL.
    """
    out = np.zeros(len(left), np.int64)
    size = np.fromiter((max(len(a), len(b)) for a, b in zip(left, right)), np.int64, len(left))
    order, at = np.argsort(size, kind="stable"), 0
    while at < len(order):
        step = order[at : at + max(1, _CELLS // max(1, int(size[order[min(len(order), at + 4096) - 1]])))][:4096]
        one, two = _letters(left[step]), _letters(right[step])
        words = max(1, -(-one.shape[1] // 64))
        row = np.full((len(step), words), ~np.uint64(0))
        place = np.zeros((len(step), words * 64), bool)
        for letter in two.T:
            place[:, : one.shape[1]] = (one == letter[:, None]) & (letter[:, None] != 0)
            met = row & np.packbits(place, axis=1, bitorder="little").view(np.uint64)
            total = np.empty_like(row)
            carry = np.zeros(len(step), np.uint64)
            for w in range(words):
                part = row[:, w] + met[:, w]
                over = part < row[:, w]
                total[:, w] = part + carry
                carry = (over | (total[:, w] < part)).astype(np.uint64)
            row = total | (row & ~met)
        out[step] = 64 * words - np.bitwise_count(row).sum(axis=1, dtype=np.int64)
        at += len(step)
    return out


@F.pandas_udf(IntegerType())
def _common_length(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(common_lengths(left.to_numpy(object), right.to_numpy(object)), dtype="int32")


def _letter_pairs(tokens: Column) -> Column:
    """Pairs of the space-padded tokens, repeated pairs numbered."""
    pairs = F.array_sort(
        F.flatten(
            F.transform(
                tokens,
                lambda t: F.transform(
                    F.sequence(F.lit(1), F.length(t) + 1),
                    lambda i: F.concat(F.lit(" "), t, F.lit(" ")).substr(i, F.lit(2)),
                ),
            )
        )
    )
    return F.transform(pairs, lambda p, i: F.concat(p, (i + 1 - F.array_position(pairs, p)).cast("string")))


def _rarest_first(names: DataFrame, parts: Column, counts: DataFrame) -> DataFrame:
    """Each name with its parts ordered by how many names hold them; a list per name only."""
    exploded = names.select("name", F.explode(parts).alias("part")).join(counts, "part")
    return exploded.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "part"))).alias("parts")).select(
        "name", F.transform("parts", lambda p: p["part"]).alias("parts")
    )


def _counts(left: DataFrame, right: DataFrame, parts: Column) -> DataFrame:
    return left.unionByName(right).select(F.explode(parts).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def _cover_prefix(parts: Column) -> Column:
    """Leading tokens whose weight first exceeds what a match may leave uncovered."""
    def weight(list_: Column) -> Column:
        return F.aggregate(list_, F.lit(0), lambda acc, t: acc + F.length(t) + 1)

    allowed = (weight(parts) - 1) * _UNCOVERED + _SLACK
    return F.filter(parts, lambda t, i: weight(F.slice(parts, F.lit(1), i)) <= allowed)


def _pair_prefix(parts: Column) -> Column:
    length = F.size(parts) - 1
    return F.slice(parts, F.lit(1), F.size(parts) - F.ceil(length * _SHARED_PAIRS - _SLACK).cast("int"))


def _needed(total: Column) -> Column:
    """Letter pairs that two names of this total length have in common at least, if their full strings match."""
    most = F.floor(total * _MAX_INDEL + _SLACK)
    indel = most - F.pmod(total - most, F.lit(2))  # even or odd as the total is
    return F.ceil(total / 2 + 1 - indel * 1.5 - _SLACK)


def _text(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def _covered(base: Column, whole: Column) -> Column:
    """Rounded ratio of the shared tokens, which begin the whole string, to it."""
    return F.when(base > 0, F.floor(200 * base / (base + whole) + 0.5)).otherwise(0)


def _once(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: it is used many times and made once."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _side(df: DataFrame, label: str, parts: Column) -> DataFrame:
    return df.select(F.col("name").alias(label), F.explode(parts).alias("part"))


def candidate_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """left_name, right_name, left_tokens, right_tokens of all pairs that may match, the filters applied.

    A pair is here because its shared tokens cover enough of a name, which decides it, or because the names share
    as many letter pairs as their lengths ask for.
    """
    named = [
        df.toDF("name").distinct().withColumn("tokens", name_tokens(F.col("name"))).filter(F.size("tokens") > 0).withColumn("is_left", F.lit(is_left))
        for df, is_left in ((left, True), (right, False))
    ]
    names = _once(named[0].unionByName(named[1]).withColumn("pairs", _letter_pairs(F.col("tokens"))), "names")
    left, right = names.filter("is_left"), names.filter("NOT is_left")
    tokens, pairs = F.col("tokens"), F.col("pairs")
    token_counts, pair_counts = _counts(left, right, tokens), _counts(left, right, pairs)
    left_cover = _side(_rarest_first(left, tokens, token_counts), "left_name", _cover_prefix(F.col("parts")))
    right_cover = _side(_rarest_first(right, tokens, token_counts), "right_name", _cover_prefix(F.col("parts")))
    known = [df.select(F.col("name").alias(f"{s}_name"), F.col("tokens").alias(f"{s}_tokens")) for s, df in (("left", left), ("right", right))]
    columns = ["left_name", "right_name"]
    shared = left_cover.join(_side(right, "right_name", tokens), "part").select(columns).union(
        _side(left, "left_name", tokens).join(right_cover, "part").select(columns)
    ).distinct().join(known[0], "left_name").join(known[1], "right_name")
    base = F.length(_text(F.array_intersect("left_tokens", "right_tokens")))
    whole = F.least(F.length(_text(F.col("left_tokens"))), F.length(_text(F.col("right_tokens"))))
    covered = shared.filter(_covered(base, whole) > THRESHOLD)

    listed = [_once(_rarest_first(df, pairs, pair_counts).withColumn("length", F.size("parts") - 1), "pairs") for df in (left, right)]
    size_class = F.floor(F.log(F.col("length").cast("double")) / math.log(_LONGER * (1 + _SLACK)) + _SLACK)
    sides = []
    for label, df, classes in (("left", listed[0], F.array(size_class - 1, size_class, size_class + 1)), ("right", listed[1], F.array(size_class))):
        spread = df.select(F.col("name").alias(f"{label}_name"), F.col("length").alias(f"{label}_length"), "parts", F.explode(classes).alias("size"))
        sides.append(spread.select(f"{label}_name", f"{label}_length", "size", F.posexplode(_pair_prefix(F.col("parts"))).alias(f"{label}_at", "part")))
    near = F.greatest("left_length", "right_length") <= F.least("left_length", "right_length") * _LONGER * (1 + _SLACK)
    behind = F.least(F.col("left_length") - F.col("left_at"), F.col("right_length") - F.col("right_at"))
    needed = _needed(F.col("left_length") + F.col("right_length"))
    possible = F.least("left_at", "right_at") + 1 + behind >= needed
    met = sides[0].join(sides[1], ["part", "size"]).filter(near & possible).select(columns).distinct()
    parts = [df.select(F.col("name").alias(f"{s}_name"), F.col("parts").alias(f"{s}_parts")) for s, df in (("left", listed[0]), ("right", listed[1]))]
    counted = met.join(parts[0], "left_name").join(parts[1], "right_name")
    total = F.size("left_parts") + F.size("right_parts") - 2
    alike = counted.filter(F.size(F.array_intersect("left_parts", "right_parts")) >= _needed(total)).select(columns)
    alike = alike.join(known[0], "left_name").join(known[1], "right_name")
    return covered.unionByName(alike).distinct()


def matching_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs (left_name, right_name, score) of two name columns scoring above 82."""
    one, two = F.col("left_tokens"), F.col("right_tokens")
    common = F.array_intersect(one, two)
    spelled = candidate_names(left, right).select(
        "left_name", "right_name", F.length(_text(common)).alias("base"),
        _text(F.concat(common, F.array_except(one, two))).alias("one"), _text(F.concat(common, F.array_except(two, one))).alias("two"),
    )
    first, second, base = F.length("one"), F.length("two"), F.col("base")
    whole = F.floor(200 * _common_length("one", "two") / (first + second) + 0.5)
    score = F.greatest(_covered(base, first), _covered(base, second), whole).cast("int")
    return spelled.select("left_name", "right_name", score.alias("score")).filter(F.col("score") > THRESHOLD)
