import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwork.functions.text_match import THRESHOLD, candidate_names, common_lengths, matching_names
from tillwork.operators.insights import item_category_match


def common_length(a, b):
    """Longest common subsequence by the usual table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def ratio(a, b):
    return int(200 * common_length(a, b) / (len(a) + len(b)) + 0.5) if a and b else 0


def token_set_score(left, right):
    common = [t for t in left if t in right]
    base = " ".join(common)
    one = " ".join(common + [t for t in left if t not in common])
    two = " ".join(common + [t for t in right if t not in common])
    return max(ratio(base, one), ratio(base, two), ratio(one, two))


def tokens(name):
    clean = "".join(c.lower() if c.isalnum() else " " for c in name)
    return sorted(set(clean.split()))


def random_names(rng, n):
    words = ["chicken", "chickens", "burger", "burgers", "cheese", "cheeseburger", "spicy", "bbq", "a", "b", "ab", "fry", "fries", "xl"]
    names = set()
    while len(names) < n:
        name = " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.4:
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice(["", "-", "z", " "]) + name[at + rng.randint(0, 1):]
        names.add(name)
    return sorted(names)


def test_candidates_lose_no_match(spark):
    rng = random.Random(4)
    left, right = random_names(rng, 150), random_names(rng, 150)
    expected = {
        (a, b, token_set_score(tokens(a), tokens(b)))
        for a in left for b in right
        if tokens(a) and tokens(b) and token_set_score(tokens(a), tokens(b)) > THRESHOLD
    }
    found = matching_names(spark.createDataFrame([(n,) for n in left], "n string"), spark.createDataFrame([(n,) for n in right], "n string"))
    assert {tuple(r) for r in found.collect()} == expected
    assert len(expected) > 100


def test_item_categories(spark):
    items = spark.createDataFrame(
        [("p1", n, "Food") for n in ("item-nm1", "item-nm2", "item-nm3", "dummy")] + [("p1", "Extra item", "Food"), ("p1", "12 oz", "Food"), ("p1", "item", "variation")],
        "partner_id string, item_nm string, item_type string",
    )
    taxonomy = spark.createDataFrame(
        [("our-item-nm1", ["c1"]), ("item-nm", ["c1", "c2"]), ("our-item-nm3", ["c3"])], "item_nm string, item_categories array<string>"
    )
    found = {tuple(r) for r in item_category_match(items, taxonomy).select("item_category", "pos_item_nm").collect()}
    assert found == {
        ("c1", "item-nm1"), ("c2", "item-nm1"), ("c1", "item-nm2"), ("c2", "item-nm2"),
        ("c1", "item-nm3"), ("c2", "item-nm3"), ("c3", "item-nm3"), ("Unknown", "dummy"),
    }


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab \U0001f600é", max_size=150), st.text(alphabet="ab \U0001f600é", max_size=150)), max_size=9))
def test_common_lengths(pairs):
    left, right = (np.array([p[i] for p in pairs], object) for i in (0, 1))
    assert common_lengths(left, right).tolist() == [common_length(a, b) for a, b in pairs]


def test_few_pairs_are_scored(spark):
    """Names of the supplied tables: at most 2 in 100 of all pairs come to a score, and every match is among them."""
    import __spark_entry__  # noqa: F401
    from tillwork.plans.bindings import Tables
    from tillwork.plans.q_insights import taxonomy
    from tillwork.operators.insights import food_items

    t = Tables(spark, "/root/testdata/sf0.01")
    left, right = food_items(t.items()).select("item_nm").distinct(), taxonomy(t).select("item_nm").distinct()
    candidates = {(r[0], r[1]) for r in candidate_names(left, right).select("left_name", "right_name").collect()}
    names = [[r[0] for r in df.collect()] for df in (left, right)]
    want = {(a, b) for a in names[0] for b in names[1] if token_set_score(tokens(a), tokens(b)) > THRESHOLD}
    assert want <= candidates and len(candidates) <= 0.02 * len(names[0]) * len(names[1])


def test_a_part_of_most_names(spark):
    """A word that most names have: its pairs of names are dropped before a score, and none that match is lost."""
    rng = random.Random(3)
    left = sorted({"chicken " + "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(120)})
    right = sorted({x[:-1] + rng.choice("xyz") for x in left} | {"chicken"})
    frames = [spark.createDataFrame([(n,) for n in names], "n string") for names in (left, right)]
    expected = {(a, b) for a in left for b in right if token_set_score(tokens(a), tokens(b)) > THRESHOLD}
    assert {(r[0], r[1]) for r in matching_names(*frames).collect()} == expected
