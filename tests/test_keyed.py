import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tillwork import session
from tillwork.operators import keyed
from tillwork.sources.bucketed import BucketedTable


def table(spark, data):
    return spark.createDataFrame(data, "k string, j int, v int")


def test_merges_match_null_keys(spark):
    target = table(spark, [("a", 1, 1), (None, 2, 2), ("c", None, 3)])
    source = table(spark, [(None, 2, 20), ("c", None, 30), ("d", 4, 40)])
    key = ["k", "j"]
    assert rows(keyed.merge_upsert(target, source, key)) == sorted([("a", 1, 1), (None, 2, 20), ("c", None, 30), ("d", 4, 40)], key=repr)
    assert rows(keyed.merge_insert_only(target, source, key)) == sorted([("a", 1, 1), (None, 2, 2), ("c", None, 3), ("d", 4, 40)], key=repr)
    assert rows(keyed.merge_delete(target, source, key)) == [("a", 1, 1)]
    kept = keyed.merge_conditional(target, source, key, {"v": F.col("v") + F.col("s_v")}, keep=F.col("v") + F.col("s_v") > 25)
    assert rows(kept) == sorted([("a", 1, 1), ("c", None, 33), ("d", 4, 40)], key=repr)


def test_upsert_is_idempotent_and_keeps_keys_unique(spark):
    target = table(spark, [("a", i, i) for i in range(20)])
    source = table(spark, [("a", i, -i) for i in range(10, 30)])
    once = keyed.merge_upsert(target, source, ["k", "j"])
    assert rows(keyed.merge_upsert(once, source, ["k", "j"])) == rows(once)
    assert keyed.duplicate_keys(once, ["k", "j"]).count() == 0
    assert keyed.duplicate_keys(once.unionByName(source), ["k", "j"]).count() == 20


def test_first_per_key_is_the_smallest_row_nulls_first(spark):
    df = table(spark, [("a", 2, 9), ("a", 1, 5), ("a", 1, 4), ("b", None, 7), ("b", 3, 1), (None, 1, 1)])
    assert rows(keyed.first_per_key(df, ["k"])) == sorted([("a", 1, 4), ("b", None, 7), (None, 1, 1)], key=repr)
    assert rows(keyed.first_per_key(df, ["k"], ["v"])) == sorted([("a", 1, 4), ("b", 3, 1), (None, 1, 1)], key=repr)


def test_few_copies_sort_once(spark):
    df = table(spark, [("a", 2, 9), ("a", 1, 5), ("b", None, 7), ("b", 3, 1), (None, 1, 1)] * 3)
    for order in (None, ["v"]):
        assert rows(keyed.first_per_key(df, ["k"], order, few_copies=True)) == rows(keyed.first_per_key(df, ["k"], order))
    plan = keyed.first_per_key(df, ["k"], few_copies=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_order_lines_are_reduced_before_the_shuffle(spark):
    """A line that is repeated many times, or has null keys, does not go whole into one task."""
    plan = queries()["item_sales_enrich"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" not in plan


def test_group_totals_equal_the_window(spark):
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 8 + ["x", "y", None]), i, rng.randint(0, 50)) for i in range(500)]
    df = table(spark, data)
    w = Window.partitionBy("k")
    expected = df.select("*", F.min("v").over(w).alias("lo"), F.max("v").over(w).alias("hi"), F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n"))
    v = F.col("v")
    actual = keyed.with_group_totals(df, ["k"], {"lo": ("min", v), "hi": ("max", v), "s": ("sum", v), "n": ("count", F.lit(1))})
    assert rows(actual) == rows(expected)
    plan = actual._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("values", [[None, 1, 2], [7], [None], [None, 3]])
def test_group_maximum_equals_the_window(spark, values):
    rng = random.Random(3)
    df = table(spark, [(rng.choice(["hot"] * 8 + ["x", "y", None]), rng.choice([1, None]), rng.choice(values)) for _ in range(400)] + [("alone", 1, None), ("lone", 1, 4)])
    expected = df.select("*", F.max("v").over(Window.partitionBy("k", "j")).alias("most"))
    assert rows(keyed.with_group_maximum(df, ["k", "j"], "most", "v", lambda groups: session.stored_once(groups, "groups"))) == rows(expected)


def test_checks_whose_lines_agree_are_shuffled_once(spark):
    """A check's tender is the largest among its copies; only checks whose copies differ are joined, and they are few."""
    plan = queries()["orders_simphony_landed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("salts", [None, 5])
def test_spread_join_equals_plain_join(spark, salts):
    rng = random.Random(2)
    big = table(spark, [(rng.choice(["hot"] * 8 + ["x", "y"]), i, i) for i in range(300)])
    small = spark.createDataFrame([("hot", "s1"), ("hot", "s2"), ("x", "s3"), ("z", "s4")], "k string, s string")
    joined = keyed.spread_join(big, small, ["k"], salts=salts)
    assert rows(joined.select("k", "j", "v", "s")) == rows(big.join(small, "k").select("k", "j", "v", "s"))


def test_group_totals_send_one_row_per_key_and_task(spark):
    """A hot key is reduced before the shuffle, and no key is cut into pieces."""
    df = spark.range(20_000).select((F.col("id") % 50).cast("string").alias("k"), F.col("id").alias("v")).repartition(4)
    out = keyed.with_group_totals(df, ["k"], {"n": ("count", F.lit(1))})
    assert out.groupBy("n").count().collect()[0].asDict() == {"n": 400, "count": 20_000}
    assert "_salt" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_merges_refuse_a_key_that_comes_twice(spark):
    target = table(spark, [("a", 1, 1), (None, 1, 2)])
    for twice in ([("a", 1, 5), ("a", 1, 6)], [(None, 1, 5), (None, 1, 6)], [("z", 1, 5), ("z", 1, 6)]):
        source = table(spark, twice)
        for merged in (
            keyed.merge_upsert(target, source, ["k", "j"]), keyed.merge_conditional(target, source, ["k", "j"], {}),
            keyed.merge_partial_update(target, source, ["k", "j"], ["v"]),
        ):
            with pytest.raises(Exception, match="several rows"):
                merged.collect()
    with pytest.raises(Exception, match="several rows"):
        keyed.merge_insert_only(target, table(spark, [("z", 1, 5), ("z", 1, 6)]), ["k", "j"]).collect()


def test_conditional_merge_reads_each_side_once(spark, tmp_path):
    for name in ("t", "s"):
        table(spark, [("a", 1, 1)]).write.parquet(str(tmp_path / name))
    sides = [spark.read.parquet(str(tmp_path / name)) for name in ("t", "s")]
    merged = keyed.merge_conditional(*sides, ["k", "j"], {"v": F.col("s_v")}, keep=F.col("s_v") > 0)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "FullOuter" in plan


def test_overwrite_where(spark):
    target = table(spark, [("a", 1, 1), ("b", 1, 2)])
    source = table(spark, [("b", 2, 3), ("c", 2, 4)])
    days = spark.createDataFrame([("b",)], "day string")
    assert rows(keyed.overwrite_where(target, source, "k", days)) == [("a", 1, 1), ("b", 2, 3)]


def ancestors(plan: str, mark: str):
    """The operators above each line of a plan that holds the mark, by indentation."""
    lines, out = plan.splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*0123456789()"))
    for i, line in enumerate(lines):
        if mark in line:
            above, at = [], depth(line)
            for upper in reversed(lines[:i]):
                if depth(upper) < at:
                    above.append(upper)
                    at = depth(upper)
            out.append(above)
    return out


def test_merges_into_buckets_shuffle_the_source_only(spark, tmp_path):
    target = spark.range(4000).selectExpr("concat('k', id % 700) AS k", "cast(id AS int) AS j", "cast(id AS int) AS v")
    source = spark.range(1000, 6000, 3).selectExpr("concat('k', id % 700) AS k", "cast(id AS int) AS j", "cast(-id AS int) AS v")
    stored = BucketedTable("merge_target_test", ("k", "j"), 8)
    stored.write(target, str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a source beyond any broadcast
    merges = [
        (keyed.merge_upsert, {}), (keyed.merge_insert_only, {}), (keyed.merge_delete, {}), (keyed.merge_partial_update, {"columns": ["v"]}),
        (keyed.merge_conditional, {"update": {"v": F.col("v") + F.col("s_v")}, "keep": F.col("v") > 100}),
    ]
    try:
        for merge, options in merges:
            found = stored.merged(spark, merge, source, **options)
            assert rows(found) == rows(merge(target, source, ["k", "j"], **options)), merge.__name__
            plan = found._jdf.queryExecution().executedPlan().toString()
            above = ancestors(plan, "FileScan parquet")
            assert above and all(not any("Exchange" in line for line in lines) for lines in above), plan
            assert any("SortMergeJoin" in line for lines in above for line in lines) and "Exchange hashpartitioning" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE merge_target_test")


def test_buckets_refuse_null_and_repeated_keys(spark, tmp_path):
    stored = BucketedTable("merge_target_nulls", ("k",), 4)
    with pytest.raises(Exception, match="null in a key"):
        stored.write(table(spark, [("a", 1, 1), (None, 2, 2)]), str(tmp_path / "t"))
    stored.write(table(spark, [("a", 1, 1), ("b", 2, 2)]), str(tmp_path / "u"))
    for bad in ([(None, 1, 1)], [("a", 1, 1), ("a", 2, 2)]):
        with pytest.raises(Exception, match="null in a key|several rows of the key"):
            stored.merged(spark, keyed.merge_upsert, table(spark, bad)).collect()
    assert rows(stored.merged(spark, keyed.merge_upsert, table(spark, []))) == [("a", 1, 1), ("b", 2, 2)]
    spark.sql("DROP TABLE merge_target_nulls")


class _Cluster:
    """A session that has no checkpoint folder, whose warehouse is on local disks."""

    def __init__(self, spark, master, folder=None):
        self._jvm, self._jsc, self.sparkContext, self.set = spark._jvm, spark._jsc, self, None
        self.master, self.folder, self.conf = master, folder, self

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.folder, "spark.sql.warehouse.dir": "file:/tmp/warehouse"}.get(key, default)

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.set = folder


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster(spark, "spark://host:7077"))
    assert session.ensure_checkpoint_dir(_Cluster(spark, "yarn", "hdfs://store/x")) == "hdfs://store/x"
    assert session.ensure_checkpoint_dir(_Cluster(spark, "local[4]")) == "file:/tmp/warehouse/_tillwork"
