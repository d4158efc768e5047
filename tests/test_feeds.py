import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwork.operators import feeds
from tillwork.sources.landing import ingest_landing
from tillwork.sources.sinks import replace_partitions, replace_within, write_partitioned


def test_market_lines(spark):
    good = '"2021-02"|"STARBUCKS"|"FOOD AND DINING"|"COFFEE SHOPS"|"AZ"|"2762"|10|10|1209.59|10.25'
    no_postal = '"2021-02"|"CHEESECAKE"|"FOOD AND DINING"|"AMERICAN"|""|""|99|105|6265.82|59.67'
    no_type = '"2021-02"|"JACK"|"FOOD AND DINING"|""|"AZ"|"2762"|144|171|2597.93|15.19'
    raw = spark.createDataFrame(
        [("zip_merch", good, "d"), ("zip_merch", no_postal, "d"), ("not_zip", good, "d"), ("zip_merch", no_type, "d"), ("zip_merch", good, "e")],
        "record_type string, record_value string, feed_date string",
    )
    expected = ("2021-01-15", "STARBUCKS", "COFFEE SHOPS", "AZ", "2762", 10, 1209.59)
    assert [tuple(r) for r in feeds.market_feed_parse(raw, "d").collect()] == [expected]
    assert feeds.market_feed_parse(raw).count() == 2


def attributes(spark, home, age):
    return spark.createDataFrame([("t1", home, age, "A")], "person_id string, owner string, age string, job string")


def test_attribute_rules_are_strict(spark):
    codes = spark.createDataFrame([("job", "A", "baker")], "code_category string, code string, code_value string")
    rules = {"keep": ["person_id"], "boolean": ["owner"], "integer": ["age"], "categories": ["job"]}
    decoded = feeds.person_attributes_decode(attributes(spark, "Yes", "40"), codes, **rules).first()
    assert tuple(decoded) == ("t1", True, 40, "baker")
    assert feeds.person_attributes_decode(attributes(spark, "unknown", None), codes, **rules).first().owner is None
    with pytest.raises(Exception):
        feeds.person_attributes_decode(attributes(spark, "perhaps", "1"), codes, **rules).collect()
    with pytest.raises(Exception):
        feeds.person_attributes_decode(attributes(spark, "y", "old"), codes, **rules).collect()
    with pytest.raises(ValueError):
        feeds.person_attributes_decode(attributes(spark, "y", "1"), codes, **{**rules, "integer": []})
    rejects = feeds.validate_codes(attributes(spark, "y", "1"), codes.filter("code = 'B'"), ["job"])
    with pytest.raises(ValueError):
        feeds.require_no_rejects(rejects)
    many = spark.createDataFrame([("t", "y", "1", f"J{i % 300}") for i in range(600)], "person_id string, owner string, age string, job string")
    found = feeds.validate_codes(many, codes, ["job"]).collect()
    assert len(found) == 300 and {r.cells for r in found} == {2}
    feeds.require_no_rejects(feeds.validate_codes(attributes(spark, "y", "1"), codes, ["job"]))


def test_landing_and_partition_writes(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        ingest_landing(spark, str(tmp_path / "empty"), "json", "a INT")
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, d string")
    write_partitioned(df, path, ["d"], first=True)
    with pytest.raises(Exception):
        write_partitioned(df, path, ["d"], first=True)
    replace_partitions(spark.createDataFrame([(9, "y")], "a int, d string"), path, ["d"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("a", "d").collect()) == [(1, "x"), (9, "y")]


def test_replace_within_drops_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(1, "2024-01-01", "a"), (2, "2024-01-01", "b:c"), (3, "2024-01-02", "a"), (4, "2024-01-03", "a"), (5, None, "a")]
    schema = "v int, day string, name string"
    spark.createDataFrame(old, schema).write.partitionBy("day", "name").parquet(path)

    def stored():
        return sorted((tuple(r) for r in spark.read.schema(schema).parquet(path).select("v", "day", "name").collect()), key=str)

    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), (None,), ("2024-01-09",)], "day string")
    new = spark.createDataFrame([(9, "2024-01-01", "b:c")], schema)
    replace_within(new, path, ["day", "name"], days)
    assert stored() == [(4, "2024-01-03", "a"), (9, "2024-01-01", "b:c")]
    with pytest.raises(ValueError):
        replace_within(new, path, ["day", "name"], days.filter("day = '2024-01-02'"))
    broken = new.withColumn("v", F.when(F.col("v") > 0, F.raise_error(F.lit("broken")).cast("int")))
    with pytest.raises(Exception):
        replace_within(broken, path, ["day", "name"], spark.createDataFrame([("2024-01-01",), ("2024-01-03",)], "day string"))
    assert stored() == [(4, "2024-01-03", "a"), (9, "2024-01-01", "b:c")]


def test_one_dictionary_lookup_for_all_columns(spark):
    names = [f"c{i}" for i in range(12)]
    raw = spark.createDataFrame([("t1", *["A"] * 12), ("t2", *[None] * 12), ("t3", *["?"] * 12)], ["person_id", *names])
    codes = spark.createDataFrame([(c, "A", f"{c} a") for c in names] + [(c, "A", f"{c} a") for c in names[:2]] + [("other", "A", "x"), ("c0", None, "y")], "code_category string, code string, code_value string")
    decoded = feeds.person_attributes_decode(raw, codes, ["person_id"], [], [], names)
    assert rows(decoded) == sorted([("t1", *[f"{c} a" for c in names]), ("t2", *[None] * 12), ("t3", *[None] * 12)], key=repr)
    plan = decoded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("ReusedSubquery") >= 11  # made once, whatever the number of columns
    with pytest.raises(Exception, match="(?i)duplicate"):  # a code with two values
        feeds.person_attributes_decode(raw, codes.union(codes.limit(1).withColumn("code_value", F.lit("z"))), ["person_id"], [], [], names).collect()
    with pytest.raises(Exception, match="more than 3 entries"):
        feeds.person_attributes_decode(raw, codes, ["person_id"], [], [], names, most=3).collect()
