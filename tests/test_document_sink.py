import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillwork.sources import document_sink as sink

SCHEMA = "id long, name string"


def frame(spark, start, end, parts=4):
    return spark.range(start, end, 1, parts).select("id", F.concat(F.lit("n"), "id").alias("name"))


def ids(spark, path):
    return sorted(r["id"] for r in sink.read_export(spark, path, SCHEMA).collect())


def staged(path):
    return [f for f in (path / "data").rglob("*.jsonl")]


def test_exports_add_replace_and_repeat(spark, tmp_path):
    path = str(tmp_path)
    assert ids(spark, path) == []
    sink.export_committed(frame(spark, 0, 50), path, ["id"], "day=1")
    sink.export_committed(frame(spark, 50, 80), path, ["id"], "day=2")
    assert ids(spark, path) == list(range(80))
    sink.export_committed(frame(spark, 0, 40), path, ["id"], "day=1")  # run again, by now with fewer rows
    assert ids(spark, path) == list(range(40)) + list(range(50, 80))
    sink.export_committed(frame(spark, 7, 9), path, ["id"], "whole", replace_all=True)
    assert rows(sink.read_export(spark, path, SCHEMA)) == [(7, "n7"), (8, "n8")]
    sink.export_committed(frame(spark, 7, 8), path, ["id"], "whole")  # again: the earlier exports stay replaced
    assert ids(spark, path) == [7]
    sink.vacuum_export(path)
    assert ids(spark, path) == [7] and len(staged(tmp_path)) == 1 and len(list((tmp_path / "_commits").iterdir())) == 1
    sink.export_committed(frame(spark, 0, 0), path, ["id"], "whole")
    assert ids(spark, path) == []
    with pytest.raises(Exception, match="name is made of"):
        sink.export_committed(frame(spark, 0, 1), path, ["id"], "a/b")


def test_nulls_long_texts_and_line_breaks(spark, tmp_path):
    data = [(1, None), (2, ""), (3, "a\nb\r\n  \"q\" ü"), (None, "x" * 300_000)]
    sink.export_committed(spark.createDataFrame(data, SCHEMA), str(tmp_path), ["id"], "one")
    assert rows(sink.read_export(spark, str(tmp_path), SCHEMA)) == sorted(data, key=repr)


def test_columns_are_mapped(spark, tmp_path):
    mapping = [{"source": "id", "dest": "_id", "cast": "string"}]
    sink.export_committed(frame(spark, 3, 5), f"file:{tmp_path}", ["_id"], "one", mapping, include_all=False)
    assert rows(sink.read_export(spark, f"file:{tmp_path}", "_id string, name string")) == [("3", None), ("4", None)]


class Broken(sink._Writer):
    """Fails after its file is staged: partition 1 in its first attempt, or in all."""

    always = False

    def write(self, iterator):
        done = super().write(iterator)
        task = TaskContext.get()
        if task.partitionId() == 1 and (self.always or task.attemptNumber() == 0):
            raise RuntimeError("lost after writing")
        return done


class BrokenAlways(Broken):
    always = True


def broken_export(writer):
    class Source(sink.DocumentExport):
        def writer(self, schema, overwrite):
            return writer(self.options["path"], self.options["export"], overwrite, schema.fieldNames().index("document"))

    return Source


def retried_job(folder):
    spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config(
        "spark.sql.adaptive.enabled", "false").config("spark.sql.warehouse.dir", f"{folder}/w").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    real, path = sink.DocumentExport, f"{folder}/x"
    sink.DocumentExport = broken_export(Broken)
    sink.export_committed(frame(spark, 0, 1000), path, ["id"], "one")
    files = {f for c in sink._commits(path) for f in c["files"]}
    assert ids(spark, path) == list(range(1000)), "each key once"
    assert len(staged(Path(path))) == len(files) + 1, "the lost attempt's file is there and does not count"
    assert sink.vacuum_export(path) == 1 and ids(spark, path) == list(range(1000))
    sink.DocumentExport = broken_export(BrokenAlways)
    try:
        sink.export_committed(frame(spark, 1000, 2000), path, ["id"], "two")
        raise SystemExit("the job should have failed")
    except Exception as error:
        assert "lost after writing" in str(error)
    # a task that still runs while the job is given up may stage a file after that: it is there, but does not count
    assert ids(spark, path) == list(range(1000)) and {f for c in sink._commits(path) for f in c["files"]} == files, "nothing of the failed job"
    sink.DocumentExport = real
    sink.export_committed(frame(spark, 1000, 2000), path, ["id"], "two")
    assert ids(spark, path) == list(range(2000))
    print("whole")


def test_a_retried_task_exports_nothing_twice(tmp_path):
    """In a process of its own: a local session retries tasks only as local[cores, failures]."""
    here = Path(__file__).resolve().parent
    code = f"import test_document_sink as t; t.retried_job({str(tmp_path)!r})"
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=240, env={**os.environ, "PYTHONPATH": f"{here.parent}:{here}"},
    )
    assert done.returncode == 0 and "whole" in done.stdout, done.stderr[-3000:]
