import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwork.operators.pos import common, square, toast
from tillwork.plans import pos_raw as raw
from tillwork.plans import q_landed
from tillwork.plans.bindings import FEED_DATE, Tables
from tillwork.sources.typed_landing import TypedLanding, covers, union_schemas

FOLDER = "/root/testdata/sf0.001"
RAW = "record_type string, record_value string, feed_date string, location_id string"
NARROW, WIDE = "id STRING, n INT, xs ARRAY<STRUCT<a: STRING>>", "id STRING, ok BOOLEAN, xs ARRAY<STRUCT<b: DOUBLE, c: STRUCT<d: INT>>>"


def plain(df):
    return rows(df.select("location_id", F.to_json("r").alias("r"), F.col("r").isNull().alias("null")))


def test_a_landing_reads_like_the_text(spark, tmp_path):
    values = [
        '{"id": "1", "n": 3, "ok": true, "xs": [{"a": "p", "b": 1.5, "c": {"d": 4}}, {"a": null}]}',
        '{"id": 17.50, "n": "no number", "ok": "maybe", "xs": [{"b": "x", "a": "kept"}], "other": [1]}',
        '{"id": {"a": 1}, "xs": []}', '{"xs": [{"c": {"d": "bad"}, "a": "kept"}, null]}', "{}", "null", "", "{broken", '["list"]', '{"n": 5, "n": 6}', None,
        '{"id": "' + "long " * 50_000 + '"}', '{"ID": "case"}',
    ]
    data = [("t", v, "d1", f"loc{i}") for i, v in enumerate(values)] + [("t", '{"id": "other day"}', "d2", "x"), ("u", '{"id": "other type"}', "d1", "y"), ("t", values[0], "d1", "loc0")]
    text = spark.createDataFrame(data, RAW)
    store = TypedLanding(spark, str(tmp_path), [("t", NARROW), ("t", WIDE), ("u", "id STRING")])
    for day in ("d1", "d2"):
        store.land(text, day)
    for kind, day in [("t", "d1"), ("t", "d2"), ("t", None), ("u", "d1"), ("u", "d2")]:
        for schema in (NARROW, WIDE) if kind == "t" else ("id STRING",):
            fields = [f"r.{f.split()[0]}" for f in schema.replace(": ", ":").split(", ") if f[0] not in "bc"]
            if "xs" in schema:
                fields[-1] = "r.xs.a" if schema == NARROW else "r.xs.c.d"
            want, got = (common.parsed(x, kind, schema, day).select("location_id", *[F.to_json(F.struct(F.expr(f))).alias(f) for f in fields]) for x in (text, store))
            assert rows(got) == rows(want), (kind, day, schema)


def test_what_is_not_landed_is_refused(spark, tmp_path):
    text = spark.createDataFrame([("t", '{"id": "1", "n": 2}', "d1", "x")], RAW)
    store = TypedLanding(spark, str(tmp_path), [("t", "id STRING")])
    with pytest.raises(ValueError, match="not landed"):
        store.records("t", "id STRING", "d1")
    store.land(text, "d1")
    assert store.records("t", "id STRING", "d1").count() == 1
    with pytest.raises(ValueError, match="d2 is not landed"):
        store.records("t", "id STRING", "d2")
    with pytest.raises(ValueError, match="landed without"):
        store.records("t", "id STRING, n INT", "d1")
    wider = TypedLanding(spark, str(tmp_path), [("t", "id STRING"), ("t", "n INT")])
    with pytest.raises(ValueError, match="not landed"):  # the new field would be null in the old files
        wider.records("t", "n INT", "d1")
    wider.land(text, "d1")
    assert [r["r"]["n"] for r in wider.records("t", "n INT", "d1").collect()] == [2]


def test_a_day_landed_again_is_replaced_and_an_unfinished_one_refused(spark, tmp_path):
    store = TypedLanding(spark, str(tmp_path), [("t", "id STRING")])
    two = spark.createDataFrame([("t", '{"id": "1"}', d, "x") for d in ("d1", "d2", "d2")], RAW)
    for day in ("d1", "d2"):
        store.land(two, day)
    assert store.records("t", "id STRING", None).count() == 3
    store.land(two.filter("feed_date = 'd1'"), "d2")  # the day has no records any more
    assert store.records("t", "id STRING", "d2").count() == 0 and store.records("t", "id STRING", None).count() == 1
    shutil.rmtree(tmp_path / "t", ignore_errors=True)
    store.land(two, "d1")
    next((tmp_path / "t").rglob("_SUCCESS")).unlink()
    with pytest.raises(ValueError, match="not landed"):
        store.records("t", "id STRING", "d1")


def test_schemas_unite_by_field(spark):
    one = union_schemas([("t", "a STRING, s STRUCT<x: INT>"), ("t", "s STRUCT<y: ARRAY<STRUCT<p: INT>>>"), ("t", "s STRUCT<y: ARRAY<STRUCT<q: INT>>>")])["t"]
    assert one.simpleString() == "struct<a:string,s:struct<x:int,y:array<struct<p:int,q:int>>>>"
    assert covers(one, union_schemas([("t", "s STRUCT<x: INT>")])["t"]) and not covers(one, union_schemas([("t", "b INT")])["t"])
    with pytest.raises(ValueError, match=r"t.s\[\].x is read as int and as string"):
        union_schemas([("t", "s ARRAY<STRUCT<x: INT>>"), ("t", "s ARRAY<STRUCT<x: STRING>>")])


def test_every_table_of_a_profile_parses_nothing_again(spark):
    t = Tables(spark, FOLDER)
    stores = {toast: q_landed.landed(t, toast.LANDING, raw.toast_orders(t), raw.toast_references(t), raw.toast_menus(t), raw.toast_locations(t)), square: q_landed.square_store(t)}
    texts = {toast: raw.together(raw.toast_orders(t), raw.toast_references(t), raw.toast_menus(t), raw.toast_locations(t)), square: raw.together(raw.square_orders(t), raw.square_customers(t), raw.square_payments(t))}
    specs = {toast: [toast.LOCATIONS, toast.CATEGORIES, toast.TENDERS, toast.PAYMENTS, toast.CUSTOMERS], square: [square.TAXES, square.TENDERS, square.PAYMENTS, square.CUSTOMERS]}
    for profile, store in stores.items():
        for spec in specs[profile]:
            table = common.project_records(store, spec, "p1", FEED_DATE)
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert "from_json" not in plan and "record_value" not in plan
            assert rows(table) == rows(common.project_records(texts[profile], spec, "p1", FEED_DATE)), spec.record_type
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # or the read schema is cut
    try:
        plan = common.project_records(stores[toast], toast.TENDERS, "p1", FEED_DATE)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    leaves = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "payments" in leaves and "selections" not in leaves and "closedDate" not in leaves, leaves
