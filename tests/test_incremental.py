import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwork.operators import changes as chg
from tillwork.operators.incremental import TRACKER, progress, run_incremental


def test_run_commits_after_the_write_only(spark, tmp_path):
    tracker, target = str(tmp_path / "tracker"), str(tmp_path / "target")
    states = [[(1, "a", 5), (2, "b", 7), (3, "c", 9)], [(1, "a", 6), (2, "b", 7), (3, "c", 9)], [(1, "a", 6), (3, "c", 9)]]
    frames = [spark.createDataFrame(s, "id int, day string, v int") for s in states]
    feed = chg.union_change_sources([chg.snapshot_changes(frames[i - 1], frames[i], ["id"], i + 1) for i in (1, 2)])
    frames[0].groupBy("day").agg(F.sum("v").alias("v")).write.partitionBy("day").parquet(target)
    spark.createDataFrame([("c", "t", 1)], TRACKER).write.parquet(tracker)

    def totals(days):
        return chg.restrict_to(frames[2], days).groupBy("day").agg(F.sum("v").alias("v"))

    def broken(days):
        return totals(days).withColumn("v", F.when(F.col("v") > 0, F.raise_error(F.lit("broken")).cast("bigint")))

    def stored():
        return rows(spark.read.parquet(target).select("day", "v"))

    with pytest.raises(Exception, match="broken"):
        run_incremental(feed, "t", tracker, "c", broken, target, "day", "day")
    assert stored() == [("a", 5), ("b", 7), ("c", 9)] and rows(progress(spark.read.parquet(tracker))) == [("c", "t", 1)]
    assert run_incremental(feed, "t", tracker, "c", totals, target, "day", "day") == (2, 3)
    assert stored() == [("a", 6), ("c", 9)] and rows(progress(spark.read.parquet(tracker))) == [("c", "t", 3)]
    assert run_incremental(feed, "t", tracker, "c", totals, target, "day", "day") is None
    spark.createDataFrame([("late", "t", 0)], TRACKER).write.mode("append").parquet(tracker)
    with pytest.raises(ValueError, match="no longer holds"):
        run_incremental(feed, "t", tracker, "late", totals, target, "day", "day")
