"""Retail views over the supplied tables, so that every operator runs on whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import codes

FEED_DATE = "2024-01-01"
AS_OF = "2001-07-31"
SALT = "pepper"
ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"]
PARTNERS = 5


class Tables:
    """The parquet tables of one folder and the views bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- identities --

    @staticmethod
    def email(custkey: Column) -> Column:
        return F.concat(F.lit("c"), custkey, F.lit("@shop"), custkey % 3, F.lit(".com"))

    @staticmethod
    def phone(custkey: Column) -> Column:
        return F.concat(F.lit("1212"), (F.floor(custkey / 3) + 2_000_000).cast("string"))

    @staticmethod
    def person(custkey: Column) -> Column:
        return F.concat(F.lit("cust"), F.floor(custkey / 30).cast("string"))

    def identity_array(self, custkey: Column) -> Column:
        def one(kind, value):
            return F.struct(F.lit(kind).alias("identity_type"), value.alias("identity_id"))

        card = F.concat(F.lit("card"), F.floor((custkey + 1) / 3).cast("string"))
        return F.array_compact(
            F.array(
                one(codes.EMAIL, self.email(custkey)),
                one(codes.PHONE, self.phone(custkey)),
                F.when((custkey % 12).isin(2, 3), one(codes.CARD_NAME, card)),
            )
        )

    # -- facts --

    def retail_orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        minutes = (k % 24) * 60 + k % 60
        return self.read("orders").select(
            k.cast("string").alias("ord_id"),
            (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))).alias("ord_timestamp"),
            F.col("o_orderdate").cast("date").alias("ord_date"),
            F.concat(F.lit("p"), k % PARTNERS).alias("partner_id"),
            F.concat(F.lit("loc"), k % 25).alias("location_id"),
            F.when(F.col("o_orderstatus") == "F", 4).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("ord_state_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("ord_pay_total"),
            (k % 7).cast("int").alias("ord_originate_channel_id"),
            (F.floor(k / 7) % 7).cast("int").alias("ord_target_channel_id"),
            F.array_compact(
                F.array(
                    F.concat(F.lit("t"), k),
                    F.when(k % 3 == 0, F.concat(F.lit("t"), F.floor(k / 2).cast("string"))),
                )
            ).alias("tender_ids"),
            self.identity_array(F.col("o_custkey")).alias("identity_ids"),
            F.col("o_custkey"),
        )

    def order_lines(self) -> DataFrame:
        lines = self.read("lineitem").select(
            F.col("l_orderkey").cast("string").alias("ord_id"),
            F.col("l_partkey").cast("string").alias("item_id"),
            F.col("l_quantity").cast("decimal(12,2)").alias("item_quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("item_total"),
        )
        return lines.join(self.retail_orders(), "ord_id")

    # -- dimensions --

    def locations(self) -> DataFrame:
        n = F.col("n_nationkey")
        zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (n % 4 + 1).cast("int"))
        return self.read("nation").join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.concat(F.lit("p"), n % PARTNERS).alias("partner_id"),
            F.concat(F.lit("loc"), n).alias("location_id"),
            F.concat(F.lit("Store "), "n_name").alias("location_nm"),
            (n % 7).cast("int").alias("location_type"),
            F.col("r_name").alias("region"),
            F.lower("n_name").alias("state_code"),
            F.concat(F.lit("city "), F.lower("n_name")).alias("city"),
            zone.alias("timezone"),
            (F.lit(30.0) + n * 0.5).alias("lat"),
            (F.lit(-120.0) + n * 1.5).alias("long"),
            F.when(n % 9 == 8, "0").otherwise("1").alias("active_flg"),
        )

    def items(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.read("part").select(
            k.cast("string").alias("item_id"),
            F.explode(F.array(*[F.lit(f"p{i}") for i in range(PARTNERS)])).alias("partner_id"),
            F.when(k % 13 == 0, F.concat(F.lit("Extra "), "p_name"))
            .when(k % 13 == 1, "12 oz")
            .when(k % 13 == 2, "Small")
            .otherwise(F.col("p_name"))
            .alias("item_nm"),
            F.when(F.col("p_size") % 3 == 0, "Food").when(F.col("p_size") % 3 == 1, "Normal").otherwise("Variation").alias("item_type"),
            F.col("p_type").alias("category"),
        )

    def tenders(self) -> DataFrame:
        p = F.col("o_orderpriority")
        return self.read("orders").select(
            F.concat(F.lit("t"), "o_orderkey").alias("tender_id"),
            F.when(p == "1-URGENT", 2).when(p == "2-HIGH", 1).when(p == "3-MEDIUM", 3)
            .when(p == "4-NOT SPECIFIED", 4).otherwise(99).alias("tender_type"),
        )

    def customer_360(self) -> DataFrame:
        """One row per 30 customer keys; every tenth customer is inactive."""
        k = F.col("c_custkey")
        number = F.floor(k / 30)
        people = self.read("customer").groupBy(number.alias("n")).agg(
            F.array_sort(F.collect_set(self.email(k))).alias("emails"),
            F.array_sort(F.collect_set(self.phone(k))).alias("phones"),
        )
        return people.select(
            F.concat(F.lit("cust"), "n").alias("customer_360_id"),
            F.create_map(F.lit(codes.EMAIL), "emails", F.lit(codes.PHONE), "phones").alias("identities"),
            F.date_add(F.lit("2000-01-01").cast("date"), (F.col("n") % 365).cast("int")).alias("create_date"),
            F.lit("2001-01-01").cast("date").alias("update_date"),
            (F.col("n") % 10 != 9).alias("active_flag"),
        )

    def device_pings(self) -> DataFrame:
        """Events near a store, moved 8500 days back into the span of the orders."""
        e, u = F.col("event_id"), F.col("user_id")
        n = (u * 7 + e) % 25
        seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - 8500 * 86400
        return self.read("events").select(
            seconds.cast("string").alias("utc_timestamp"),
            (F.lit(30.0) + n * 0.5 + ((e % 41) - 20) * 0.0005).alias("latitude"),
            (F.lit(-120.0) + n * 1.5 + ((e % 37) - 18) * 0.0005).alias("longitude"),
            (e % 60).cast("double").alias("horizontal_accuracy"),
            F.when(u % 2 == 0, codes.MAID_AAID).otherwise(codes.MAID_IDFA).alias("id_type"),
            F.when(u % 2 == 0, F.concat(F.lit("dev"), u)).alias("advertiser_id_AAID"),
            F.when(u % 2 == 1, F.concat(F.lit("dev"), u)).alias("advertiser_id_IDFA"),
        )
