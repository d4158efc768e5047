from pyspark.sql import functions as F

from tillwork.functions import fields

PHONES = [
    "2124567890", "212-456-7890", "(212)456-7890", "(212)-456-7890", "212.456.7890", "212 456 7890", "+12124567890",
    "+1 212.456.7890", "1-212-456-7890", "12124567890", "  12124567890  ",
]
NOT_PHONES = [None, "", " ", "123456789", "!@!$#", "123--123--1234", "+212-456-7890", "1ABC2124567890"]
EMAILS = ["paul123@mailbox.com", "PAUL123@mailbox.com", "Paul123@mailBoX.com", " Paul123@Mailbox.Com "]
NOT_EMAILS = [None, "some@host", "", "@domain.com", " ", "123@123.123"]


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_contacts(spark):
    assert set(apply(spark, PHONES, fields.phone)) == {"12124567890"}
    assert set(apply(spark, NOT_PHONES, fields.phone)) == {None}
    assert set(apply(spark, EMAILS, fields.email)) == {"paul123@mailbox.com"}
    assert set(apply(spark, NOT_EMAILS, fields.email)) == {None}
    assert apply(spark, [" ab-c ", ""], fields.advertiser_id) == ["AB-C", None]


def test_money_zip_city(spark):
    assert [str(v) if v is not None else None for v in apply(spark, ["12345", "500", " 7 ", "x", None], fields.cents_to_money)] == [
        "123.45", "5.00", "0.07", None, None,
    ]
    assert apply(spark, ["12345", "12345-6789", "1234", "12345-67", "123456"], fields.zip_code) == ["12345", "12345", None, None, None]
    assert apply(spark, ["New\tYork\n", "Los\\n Angeles"], fields.city_text) == ["NewYork", "Los Angeles"]


def test_year_week(spark):
    assert [str(d) for d in apply(spark, ["2021-02", "2022-01"], fields.year_week_to_date)] == ["2021-01-15", "2022-01-07"]


def test_qualified_identity_splits_at_first_colon(spark):
    df = spark.createDataFrame([("ipv6:fe80::1",)], "q string")
    row = df.select(fields.identity_type_of(F.col("q")), fields.identity_id_of(F.col("q"))).first()
    assert tuple(row) == ("ipv6", "fe80::1")


def test_hash_of_nothing_is_null(spark):
    hashed = apply(spark, ["a", " a ", "", None], lambda c: fields.salted_hash(c, "s"))
    assert hashed[0] == hashed[1] and len(hashed[0]) == 64 and hashed[2:] == [None, None]
