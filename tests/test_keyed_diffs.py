import random
import time
from decimal import Decimal

from conftest import rows

from tillwork.operators import changes as chg
from tillwork.streaming.change_stream import read_changes
from tillwork.streaming.keyed_diffs import keyed_diffs, maintain_diffs, read_diffs

SCHEMA = "id int, name string, amount decimal(10,2), tags array<string>, _change_type string, _commit_version bigint"


def feed(rng, keys, versions):
    """Random inserts, updates and deletes; every version touches a key at most once, or deletes and inserts it again."""
    state, out = {}, []
    for version in range(1, versions + 1):
        for key in [None, *range(keys)]:
            new = (key, rng.choice("abc"), None if rng.random() < 0.1 else rng.randint(0, 99), [rng.choice("xyz")])
            row = lambda r, kind: (*r[:2], r[2], r[3], kind, version)
            if rng.random() < 0.4:
                continue
            if key not in state:
                state[key] = new
                out.append(row(new, "insert"))
            elif rng.random() < 0.4:
                out.append(row(state.pop(key), "delete"))
                if rng.random() < 0.3:
                    state[key] = new
                    out.append(row(new, "insert"))
            else:
                out += [row(state[key], "update_preimage"), row(new, "update_postimage")]
                state[key] = new
    return out


def frame(spark, some):
    return spark.createDataFrame([(*r[:2], None if r[2] is None else Decimal(r[2]), *r[3:]) for r in some], SCHEMA)


def test_any_split_gives_the_diff_of_the_whole_feed(spark, tmp_path):
    """Batches in any order, replayed rows and unknown kinds among them, and a restart from the checkpoint after each."""
    for seed in range(2):
        rng = random.Random(seed)
        whole = feed(rng, 8, 5)
        base = tmp_path / str(seed)
        arriving, target, checkpoint = (str(base / n) for n in ("in", "diffs", "checkpoint"))
        parts = [[] for _ in range(2 + seed)]
        for row in rng.sample(whole, len(whole)):
            rng.choice(parts).append(row)
        parts[-1] += parts[0][:3] + [(1, "z", 1, ["z"], "unknown", 0), (99, "z", 1, ["z"], "unknown", 9)]
        for i, part in enumerate(parts):
            frame(spark, part).coalesce(1).write.mode("append").parquet(arriving)
            maintain_diffs(read_changes(spark, arriving, frame(spark, []).schema, max_files=1), ["id"], target, checkpoint).awaitTermination()
            so_far = [r for p in parts[: i + 1] for r in p]
            assert rows(read_diffs(spark, target)) == rows(chg.collapse_changes(frame(spark, set_of(so_far)), ["id"])), (seed, i)
        assert any(r[0] is None or r[1] is None for r in rows(read_diffs(spark, target)))


def set_of(some):
    return [list(r[:3]) + [list(r[3])] + list(r[4:]) for r in dict.fromkeys((*r[:3], tuple(r[3]), *r[4:]) for r in some)]


def test_state_is_forgotten(spark, tmp_path):
    """After forget_after seconds a key's rows start a new diff."""
    arriving, target, checkpoint = (str(tmp_path / n) for n in ("in", "diffs", "checkpoint"))
    steps = [[(1, "a", 1, ["x"], "insert", 1)], [(1, "a", 1, ["x"], "update_preimage", 2), (1, "b", 2, ["x"], "update_postimage", 2)]]
    for step in steps:
        frame(spark, step).coalesce(1).write.mode("append").parquet(arriving)
        maintain_diffs(read_changes(spark, arriving, frame(spark, []).schema), ["id"], target, checkpoint, forget_after=1).awaitTermination()
    # a run takes longer than a second: the insert is forgotten, so the update's old record is the previous one
    found = rows(read_diffs(spark, target))
    assert [(p and p["name"], c["name"]) for p, c in found] in ([("a", "b")], [(None, "b")])
    time.sleep(1.5)
    frame(spark, [(1, "b", 2, ["x"], "delete", 3)]).coalesce(1).write.mode("append").parquet(arriving)
    maintain_diffs(read_changes(spark, arriving, frame(spark, []).schema), ["id"], target, checkpoint, forget_after=1).awaitTermination()
    found = rows(read_diffs(spark, target))
    assert [(p["name"], c) for p, c in found] == [("b", None)]


def test_kept_state_needs_no_python(spark, tmp_path):
    arriving = str(tmp_path / "in")
    frame(spark, [(1, "a", 1, ["x"], "insert", 1)]).write.parquet(arriving)
    stream = read_changes(spark, arriving, frame(spark, []).schema)
    kept, expiring = (keyed_diffs(stream, ["id"], ttl)._jdf.queryExecution().analyzed().toString() for ttl in (None, 1))
    assert "PySpark" in expiring
    assert "PySpark" not in kept and "InArrow" not in kept
