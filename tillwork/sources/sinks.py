"""Partitioned writes and document exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.sources.mapping import map_columns


def write_partitioned(df: DataFrame, path: str, partitions: list[str], first: bool = False) -> None:
    """Append partitions; a first write refuses to touch an existing path."""
    df.write.mode("errorifexists" if first else "append").partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace exactly the partitions that df has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def replace_within(df: DataFrame, path: str, partitions: list[str], scope: DataFrame) -> None:
    """Replace all partitions below the values of scope, also those df has no rows for any more.

    scope holds values of the first partition columns (a list of days, say: a bounded list, brought to the
    driver). The partitions of df are overwritten and what else lies below a value of scope is deleted; rows
    outside scope are refused. A failed write deletes nothing.
    """
    spark = df.sparkSession
    lead = partitions[: len(scope.columns)]
    wanted = {tuple(r) for r in scope.distinct().collect()}
    df = df.persist()
    try:
        present = {tuple(r) for r in df.select(*partitions).distinct().collect()}
        if outside := {p[: len(lead)] for p in present} - wanted:
            raise ValueError(f"rows outside the values to replace: {sorted(map(str, outside))[:10]}")
        replace_partitions(df, path, partitions)
    finally:
        df.unpersist()
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName

    def folder(names: list[str], values: tuple) -> str:
        return "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None or v == '' else escape(str(v))}" for n, v in zip(names, values))

    kept = {folder(partitions, p) for p in present}
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for values in wanted:
        below = [f"{path}/{folder(lead, values)}"]
        for name in partitions[len(lead):]:
            below = [s.getPath().toString() for b in below if files.exists(fs_path(b)) for s in files.listStatus(fs_path(b)) if s.getPath().getName().startswith(f"{name}=")]
        for old in below:
            if "/".join(old.split("/")[-len(partitions):]) not in kept:
                files.delete(fs_path(old), True)


def documents(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, document): the row as JSON under its key columns."""
    return df.select(F.concat_ws("|", *key).alias("key"), F.to_json(F.struct(*df.columns)).alias("document"))


def export_documents(
    df: DataFrame, path: str, key: list[str], mapping: list[dict] | None = None, include_all: bool = True,
    format: str = "json", mode: str = "overwrite", **options: str,
) -> None:
    """Map columns and write documents clustered by key ranges, as JSON lines or any given format."""
    mapped = df if mapping is None else map_columns(df, mapping, include_all)
    mapped.repartitionByRange(*key).write.format(format).options(**options).mode(mode).save(path)


def export_search_profile(profiles: DataFrame, path: str) -> None:
    """One JSON document per customer under the customer's id."""
    documents(profiles, ["customer_360_id"]).write.mode("overwrite").parquet(path)
