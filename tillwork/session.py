"""Session settings the library relies on, and the folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

JOIN_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

# Runtime SQL settings; none of them needs a restart and none pins a machine size.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE split a hot join partition even when that costs one more shuffle above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join deals its sides by all its keys again, unless the query says that it dealt them itself (joins_as_dealt)
    JOIN_KEYS: "true",
    # what a Python worker holds of its input at a time, whatever the length of the rows (one row at least)
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304b",
}


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def joins_as_dealt(spark: SparkSession) -> None:
    """For the query being made: a join whose sides are both dealt by some of its keys is not shuffled again. The next query starts without it."""
    spark.conf.set(JOIN_KEYS, "false")


def _scheme(spark: SparkSession, folder: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where that is unset, one below the session's warehouse.

    On a cluster a warehouse on local disks is refused: each executor would write to its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tillwork"
    master = sc.master
    if not spark.conf.get("spark.checkpoint.dir", None) and not (master == "local" or master.startswith("local[")) and _scheme(spark, folder) == "file":
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: the warehouse {folder} is on local disks")
    sc.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder, shared by the driver and all executors."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillwork-{name}-{uuid.uuid4().hex}"


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to a scratch folder and read from there: what joins them knows their size, and they are not made again."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder, compression="zstd")
    return df.sparkSession.read.parquet(folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
