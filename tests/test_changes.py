import random

import pytest
from conftest import rows

from tillwork.operators import changes as chg

FEED = "id int, v string, _change_type string, _commit_version bigint"


def collapse(spark, data):
    diff = chg.collapse_changes(spark.createDataFrame(data, FEED), ["id"])
    out = diff.select("previous_record.id", "previous_record.v", "current_record.id", "current_record.v")
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize(
    "data, expected",
    [
        ([(1, "a", "insert", 1)], [(None, None, 1, "a")]),
        ([(1, "a", "insert", 1), (1, "a", "insert", 1)], [(None, None, 1, "a")]),
        ([(1, "a", "insert", 1), (1, "a", "update_preimage", 2), (1, "b", "update_postimage", 2)], [(None, None, 1, "b")]),
        ([(1, "a", "update_preimage", 2), (1, "b", "update_postimage", 2)], [(1, "a", 1, "b")]),
        ([(1, "a", "delete", 1)], [(1, "a", None, None)]),
        ([(1, "a", "insert", 1), (1, "a", "delete", 2)], []),
        ([(1, "a", "delete", 2), (1, "b", "insert", 2)], [(1, "a", 1, "b")]),
        ([(1, "a", "delete", 1), (1, "b", "insert", 3)], [(1, "a", 1, "b")]),
    ],
)
def test_collapse_cases(spark, data, expected):
    assert collapse(spark, data) == expected


def test_replaying_the_diff_gives_the_new_snapshot(spark):
    rng = random.Random(3)
    versions = [{i: rng.choice("abc") for i in range(60) if rng.random() < 0.7} for _ in range(4)]
    frames = [spark.createDataFrame(list(v.items()), "id int, v string") for v in versions]
    feed = chg.union_change_sources([chg.snapshot_changes(frames[i - 1], frames[i], ["id"], i) for i in (1, 2, 3)])
    state = dict(versions[0])
    for row in chg.collapse_changes(feed, ["id"]).collect():
        if row.previous_record is not None:
            assert state.pop(row.previous_record.id) == row.previous_record.v
        if row.current_record is not None:
            state[row.current_record.id] = row.current_record.v
    assert state == versions[-1]


def test_union_of_different_shapes_fails(spark):
    a = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        chg.union_change_sources([a, spark.createDataFrame([("1",)], "x string")])


def test_feed_columns_are_required(spark):
    with pytest.raises(ValueError):
        chg.collapse_changes(spark.createDataFrame([(1,)], "id int"), ["id"])


def test_snapshot_as_diff(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert rows(chg.snapshot_as_diff(df).select("previous_record", "current_record.v")) == [(None, "a")]
