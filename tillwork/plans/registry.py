"""Register queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.plans.bindings import Tables
from tillwork.plans.sql_views import with_views
from tillwork.session import tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(Tables(tuned(spark), folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Plain columns only: dates and times as text, decimals as doubles, lists joined by '|'."""

    def plain(field: T.StructField):
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, T.ArrayType):
            c = F.when(c.isNotNull(), F.array_join(c.cast("array<string>"), "|"))
        elif isinstance(t, T.NullType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])
