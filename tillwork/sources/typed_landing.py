"""Raw records parsed once at landing: a typed table per record type, from which every table of a profile is read.

Parsing JSON again for each table is most of a vendor profile's cost. Here the text of a record is parsed
when it lands, by the union of all schemas its readers use, and stored as Parquet structs; a table then reads
the leaves it needs (nested column pruning) and no text. The raw table keeps the text: a landing is derived from
it and can be made again, which a changed schema asks for.

    <path>/<record type>/<digest of the schema>/feed_date=<day>/
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_type(one: T.DataType, two: T.DataType, at: str = "r") -> T.DataType:
    """Structs field by field, arrays by element; any other two types must be the same one."""
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        fields = {f.name: f for f in one.fields}
        for f in two.fields:
            known = fields.get(f.name)
            fields[f.name] = f if known is None else T.StructField(f.name, union_type(known.dataType, f.dataType, f"{at}.{f.name}"))
        return T.StructType(list(fields.values()))
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(union_type(one.elementType, two.elementType, f"{at}[]"))
    if one != two:
        raise ValueError(f"{at} is read as {one.simpleString()} and as {two.simpleString()}: a landing has one type for it")
    return one


def covers(wide: T.DataType, narrow: T.DataType) -> bool:
    try:
        return union_type(wide, narrow) == wide
    except ValueError:
        return False


def union_schemas(readers: list[tuple[str, str]]) -> dict[str, T.StructType]:
    """(record type, schema as DDL) of every reader to one schema per record type."""
    found: dict[str, T.StructType] = {}
    for record_type, ddl in readers:
        schema = T.StructType.fromDDL(ddl)
        found[record_type] = union_type(found.get(record_type, T.StructType()), schema, record_type)
    return found


class TypedLanding:
    """The typed records below a path, by the schemas (record type, DDL) of their readers."""

    def __init__(self, spark: SparkSession, path: str, readers: list[tuple[str, str]]):
        self.spark, self.path, self.schemas = spark, path.rstrip("/"), union_schemas(readers)

    def folder(self, record_type: str) -> str:
        schema = self.schemas[record_type]
        return f"{self.path}/{record_type}/{hashlib.sha256(schema.json().encode()).hexdigest()[:16]}"

    def land(self, raw: DataFrame, feed_date: str) -> None:
        """Parse the records of one feed date, all record types; a day that was landed before is replaced.

        Columns of raw other than record_type, record_value and feed_date stay as they are. A record without a
        value is left out; a malformed one has a struct of nulls, as from_json reads it in every table.
        """
        others = [n for n in raw.columns if n not in ("record_type", "record_value", "feed_date")]
        for record_type, schema in self.schemas.items():
            wanted = (F.col("record_type") == record_type) & (F.col("feed_date") == feed_date) & F.col("record_value").isNotNull()
            rows = raw.filter(wanted).select(*others, F.from_json("record_value", schema).alias("r"))
            rows.write.mode("overwrite").parquet(f"{self.folder(record_type)}/feed_date={feed_date}", compression="zstd")

    def records(self, record_type: str, schema: str, feed_date: str | None) -> DataFrame:
        """The other columns and the struct r, of the fields of schema alone: no other leaf is read; None reads all landed days.

        Refused where the landing's schema lacks a field, and where a day was not landed whole.
        """
        wanted = T.StructType.fromDDL(schema)
        if not covers(self.schemas.get(record_type, T.StructType()), wanted):
            raise ValueError(f"{record_type} was landed without some of: {schema}")
        folder = self.folder(record_type)
        days = self._days(folder)
        if feed_date is not None:
            days = {d: whole for d, whole in days.items() if d == feed_date}
        if not days or not all(days.values()):
            raise ValueError(f"{record_type} of {feed_date or 'any day'} is not landed in this schema: {folder} has {days}")
        paths = [f"{folder}/feed_date={d}" for d in sorted(days)]
        others = [f for f in self.spark.read.parquet(*paths).schema if f.name != "r"]
        return self.spark.read.schema(T.StructType([*others, T.StructField("r", wanted)])).parquet(*paths)

    def _days(self, folder: str) -> dict[str, bool]:
        """Landed days, and whether each was written to its end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path(folder)):
            return {}
        found = [s.getPath().toString() for s in files.listStatus(path(folder))]
        return {f.rsplit("feed_date=", 1)[1]: files.exists(path(f"{f}/_SUCCESS")) for f in found if "/feed_date=" in f}
