"""Landing files to raw records: one row per JSON record, in one pass over the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMON = ["feed_date", "file_name", "source_id"]


def ingest_landing(spark: SparkSession, path: str, file_format: str, schema: str | None = None, **options: str) -> DataFrame:
    """Every file below the folder, with its path; fails when there is nothing to read."""
    reader = spark.read.format(file_format).options(recursiveFileLookup="true", **options)
    df = (reader.schema(schema) if schema else reader).load(path)
    df = df.select("*", F.col("_metadata.file_path").alias("_path"))
    if df.isEmpty():
        raise ValueError(f"no landing data below {path}")
    return df


def path_tail(path: Column, parts: int) -> Column:
    """The last parts of a path."""
    return F.substring_index(path, "/", -parts)


def stamp_provenance(df: DataFrame, feed_date: str, source_id: str, path_parts: int) -> DataFrame:
    """Feed date, the tail of the file path, the source, and a random row id."""
    return df.select(
        *[c for c in df.columns if c != "_path"],
        F.lit(feed_date).alias("feed_date"), path_tail(F.col("_path"), path_parts).alias("file_name"),
        F.lit(source_id).alias("source_id"), F.uuid().alias("row_id"),
    )


def _as_record(value: Column, kind: T.DataType) -> Column:
    """Structures as JSON, anything else as text."""
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(value) if nested else value.cast("string")


def _records(df: DataFrame, column: str) -> Column:
    """The column's elements (or its one value) as (record_type, record_value)."""
    kind = df.schema[column].dataType
    values = F.col(f"`{column}`") if isinstance(kind, T.ArrayType) else F.array(F.col(f"`{column}`"))
    element = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return F.coalesce(
        F.transform(values, lambda v: F.struct(F.lit(column).alias("record_type"), _as_record(v, element).alias("record_value"))),
        F.array().cast("array<struct<record_type:string,record_value:string>>"),
    )


def explode_records(df: DataFrame, entities: list[str], keep: dict[str, str]) -> DataFrame:
    """One row per element of the entity columns, each under its own type.

    keep maps other columns to their output names. All entities leave the document together,
    so a document is read and parsed once.
    """
    rows = F.filter(F.concat(*[_records(df, e) for e in entities]), lambda r: r["record_value"].isNotNull())
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in keep.items()], F.inline(rows))


def _others(df: DataFrame, *known: str) -> list[str]:
    return [c for c in df.columns if c not in (*COMMON, "row_id", *known)]


def explode_records_wide(df: DataFrame) -> DataFrame:
    """A document with one array per entity and a paging cursor."""
    return explode_records(df, _others(df, "cursor"), {c: c for c in COMMON})


# fixed values: header columns and their names in the raw table
SIMPHONY_HEADER = {
    "curUTC": "cur_utc", "locRef": "loc_ref", "busDt": "bus_dt", "opnBusDt": "opn_bus_dt", "latestBusDt": "latest_bus_dt",
}
QUBEYOND_REQUEST = [
    "req_customer_id", "req_location_id", "req_data_type", "req_sub_data_type", "data_delta", "req_start_date", "req_end_date",
]


def explode_records_simphony(df: DataFrame) -> DataFrame:
    header = {c: n for c, n in SIMPHONY_HEADER.items() if c in df.columns}
    return explode_records(df, _others(df, *SIMPHONY_HEADER), {**header, **{c: c for c in COMMON}})


def explode_records_qubeyond(df: DataFrame) -> DataFrame:
    """The entities sit below data; the request columns are kept."""
    inner = df.select("data.*", *COMMON, *QUBEYOND_REQUEST)
    return explode_records(inner, _others(inner, *QUBEYOND_REQUEST), {c: c for c in [*COMMON, *QUBEYOND_REQUEST]})


def explode_records_embedded(df: DataFrame) -> DataFrame:
    inner = df.select("_embedded.*", *COMMON)
    return explode_records(inner, _others(inner), {c: c for c in COMMON})


def _payload_records(value: Column, singular: Column) -> Column:
    """The records of a JSON text: the whole text when singular, else the array's elements as text."""
    return F.when(singular, F.array(value)).otherwise(F.from_json(value, "array<string>"))


def _routed(df: DataFrame, record_type: Column, location: Column, singular: list[str]) -> DataFrame:
    typed = df.select("value", *COMMON, record_type.alias("record_type"), location.alias("location_id"))
    records = _payload_records(F.col("value"), F.col("record_type").isin(singular))
    rows = typed.select("record_type", "location_id", *COMMON, F.explode(records).alias("record_value"))
    return rows.filter(F.col("record_value").isNotNull())


def route_text_parbrink(df: DataFrame) -> DataFrame:
    """Type: file name up to its first '_'; store: first path part without 'location='."""
    name = path_tail(F.col("file_name"), 1)
    store = F.replace(F.substring_index("file_name", "/", 1), F.lit("location="), F.lit(""))
    return _routed(df, F.substring_index(name, "_", 1), store, ["options"])


def route_text_toast(df: DataFrame) -> DataFrame:
    """Type: path part 7; an order's store: path part 8 without 'restaurant='; menus stay whole."""
    parts = F.split("file_name", "/")
    kind = F.get(parts, F.lit(7))
    store = F.when(kind == "orders", F.replace(F.get(parts, F.lit(8)), F.lit("restaurant="), F.lit("")))
    return _routed(df, kind, store, ["restaurants", "menus"])


# fixed value: file names look like YYYYMM_xxx_<record type>.csv.gz
_NAME_PREFIX, _NAME_SUFFIX = 11, len(".csv.gz")


def split_csv_payload(df: DataFrame) -> DataFrame:
    """Type cut out of the file name; the first non-null payload column is the record."""
    length = F.length("file_name") - (_NAME_PREFIX + _NAME_SUFFIX)
    return df.select(
        F.substring("file_name", F.lit(_NAME_PREFIX + 1), length).alias("record_type"),
        F.coalesce(*[F.col(f"`{c}`") for c in _others(df)]).alias("record_value"),
        *COMMON,
    )


def split_device_ping(df: DataFrame) -> DataFrame:
    """Ad id by platform, IP address by version, platform in upper case."""
    kind, ad, ip = F.col("id_type"), F.col("ad_id"), F.col("ip_address")
    six = ip.contains(":")
    return df.withColumns(
        {
            "advertiser_id_AAID": F.when(kind == "aaid", ad),
            "advertiser_id_IDFA": F.when(kind == "idfa", ad),
            "advertiser_id_UNKNOWN": F.when(~kind.isin("aaid", "idfa"), ad),
            "ipv_4": F.when(~six, ip),
            "ipv_6": F.when(six, ip),
            "id_type": F.upper(kind),
        }
    ).drop("ad_id", "ip_address")
