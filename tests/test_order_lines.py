"""What an order's lines share is made once per order; signals are made once for their running totals."""

import json

import pytest
from conftest import rows

from pyspark.sql import functions as F

from tillwork.operators import loyalty, pos
from tillwork.operators.pos import common as c
from tillwork.plans import load_all, pos_raw, q_landed, q_signals
from tillwork.plans import q_pos_parbrink as parbrink
from tillwork.plans import q_pos_square as square
from tillwork.plans import q_pos_toast as toast
from tillwork.plans.bindings import Tables
from tillwork.sources.typed_landing import TypedLanding

load_all()
FOLDER = "/root/testdata/sf0.001"
ORDERS = [
    ("1", "2024-01-01 10:00:00", [("a", "1"), ("b", "x")]), ("2", None, [("a", "2")]), ("3", "2024-01-02 10:00:00", []),
    ("4", "2024-01-03 10:00:00", None), (None, "2024-01-03 11:00:00", [(None, "3")]), ("1", "2024-01-01 10:00:00", [("a", "1")]),
]


def test_lines_of_whole_orders_are_those_of_unnested_ones(spark):
    orders = spark.createDataFrame(ORDERS, "id string, at string, items array<struct<item: string, n: string>>")
    own = {"ord_id": "id", "ord_date": "at", "ord_timestamp": "at"}
    of_line = {"item_id": "x.item", "item_quantity": "x.n"}
    plain = c.order_lines(orders.withColumn("x", F.explode("items")), {**own, **of_line}, "2024-01-01")
    whole = c.order_lines(orders, own, "2024-01-01", ("x", "items"), of_line)
    assert whole.schema == plain.schema and rows(whole) == rows(plain) and whole.count() == 4


def test_times_are_parsed_before_the_lines_are_unnested(spark):
    plan = square.q_orders(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    unnested = next(i for i, line in enumerate(plan) if "Generate explode(_lines" in line)
    assert not any("closed_at" in line for line in plan[:unnested]) and any("closed_at" in line for line in plan[unnested:])


def test_orders_are_reduced_before_their_identities_are_unnested(spark):
    lines = spark.createDataFrame(
        [("1", "p", "s", "2024-01-01", 5, [("email", "a"), ("phone", "b")])] * 3 + [("1", "p", "s", "2024-01-01", 4, [("email", "a")]), ("2", "p", "s", None, 1, [("email", "a")])]
        + [("3", "p", "s", "2024-01-02", 7, [(None, "a"), ("email", None), ("phone", "z")]), ("4", "p", "s", "2024-01-02", 8, None), ("5", "p", "s", "2024-01-02", 9, [])],
        "ord_id string, partner_id string, location_id string, ord_date string, ord_pay_total int, identity_ids array<struct<identity_type: string, identity_id: string>>",
    )
    people = spark.createDataFrame([("c1", "email:a"), ("c1", "phone:b"), ("c2", "phone:b"), ("c3", "phone:z")], "customer_360_id string, qualified_identity string")
    out = loyalty.orders_by_customer(lines, people)
    assert rows(out.select("customer_360_id", "ord_id", "ord_date", "ord_pay_total")) == [
        ("c1", "1", "2024-01-01", 4), ("c2", "1", "2024-01-01", 5), ("c3", "3", "2024-01-02", 7),
    ]
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    unnested = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Aggregate [" in line for line in plan[unnested:])


def test_signals_of_totals_are_not_sorted_by_day(spark, monkeypatch):
    """A range sort makes them once more to sample them."""
    made = []
    daily = q_signals.daily_signals
    monkeypatch.setattr(q_signals, "daily_signals", lambda t: made.append(daily(t)) or _Unsorted(made[-1]))
    q_signals.q_period_totals(Tables(spark, FOLDER))
    assert len(made) == 1


class _Unsorted:
    def __init__(self, df):
        self.write = df.write  # no repartitionByRange


def square_text(order, location, created, lines):
    items = None if lines is None else [line and {"uid": line[0], "catalog_object_id": line[1], "quantity": line[2], "total_money": {"amount": line[3]}} for line in lines]
    return json.dumps({"id": order, "location_id": location, "created_at": created, "total_money": {"amount": "900"}, "line_items": items})


def ticket_text(order, location, created, lines):
    items = None if lines is None else [line and {"id": line[1], "quantity": line[2], "price": line[3]} for line in lines]
    seconds = created and {"2024-01-01T10:00:00Z": 1704103200, "2024-01-02T10:00:00Z": 1704189600}[created]
    return json.dumps({"id": order, "opened_at": seconds, "_links": {"self": {"href": f"https://api/1.0/locations/{location}/"}}, "_embedded": {"items": items}})


@pytest.mark.parametrize("profile, kind, text", [(pos.square, "orders", square_text), (pos.omnivore, "tickets", ticket_text)])
def test_orders_of_a_landing_are_those_of_its_text(spark, tmp_path, profile, kind, text):
    """Orders that come once pass unreduced; replayed, restated, nameless ones and repeated items are reduced."""
    one, two = "2024-01-01T10:00:00Z", "2024-01-02T10:00:00Z"
    records = [
        ("once", "s1", one, [("u1", "a", "1", "100"), ("u2", "b", "x", "200")]), ("once", "s2", one, [("u3", "a", "2", "50")]),
        ("items", "s1", one, [("u1", "a", "2", "100"), ("u0", "a", "1", "100"), ("u2", "b", "1", "7"), (None, None, "1", "5"), ("u4", None, "1", "3")]),
        ("again", "s1", one, [("u1", "a", "1", "100")]), ("again", "s1", one, [("u1", "a", "1", "90"), ("u2", "c", "1", "10")]),
        ("moved", "s1", one, [("u1", "a", "1", "100")]), ("moved", "s1", two, [("u1", "a", "1", "90")]),
        (None, "s1", one, [("u1", "a", "1", "100")]), (None, "s1", one, [("u1", "a", "1", "80")]), (None, "s2", one, [("u9", "z", "1", "1")]),
        ("untimed", "s1", None, [("u1", "a", "1", "100")]), ("empty", "s1", one, []), ("none", "s1", one, None), ("hole", "s1", one, [None, ("u1", "a", "1", "1")]),
    ] + [("replay", "s3", one, [("u1", "a", "1", "100"), ("u2", "b", "1", "200")])] * 20
    raw = spark.createDataFrame([(kind, text(*r), "2024-01-01") for r in records] + [(kind, "{broken", "2024-01-01")], "record_type string, record_value string, feed_date string")
    store = TypedLanding(spark, str(tmp_path), profile.LANDING)
    store.land(raw, "2024-01-01")
    known = spark.createDataFrame([("once", "s1", ["i1"]), ("again", "s1", ["i2", "i3"]), ("replay", "s3", ["i4"])], "ord_id string, location_id string, identity_ids array<string>")
    want, got = (profile.orders(x, known, "p", "2024-01-01") for x in (raw, store))
    assert got.schema == want.schema and rows(got) == rows(want)
    assert [(r.ord_id, r.location_id, r.item_id, str(r.item_total), r.identity_ids) for r in got.filter("ord_id in ('again', 'replay')").sort("ord_id", "item_id").collect()] == [
        ("again", "s1", "a", "0.90", ["i2", "i3"]), ("again", "s1", "c", "0.10", ["i2", "i3"]), ("replay", "s3", "a", "1.00", ["i4"]), ("replay", "s3", "b", "2.00", ["i4"]),
    ]
    assert [str(r.item_total) for r in got.filter("ord_id = 'items'").sort("item_id").collect()] == ["0.03", "1.00", "0.07"]


@pytest.mark.parametrize("query", [q_landed.q_square, q_landed.q_omnivore])
def test_orders_that_come_once_are_unnested_last(spark, query):
    """They are shuffled whole to their identities, and their lines are neither shuffled nor sorted after it."""
    plan = query(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    once = next(i for i, line in enumerate(plan) if "LeftAnti" in line)
    above = [line for line in plan[:once] if not line.lstrip(" :+-").startswith("Project")]
    assert [line.lstrip(" :+-").split()[0] for line in above] == ["Union", "Generate", "Join"]


def test_a_landing_is_read_by_the_fields_of_its_reader(spark):
    plan = q_landed.q_omnivore(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan()
    read = [plan.collectLeaves().apply(i).schema().simpleString() for i in range(plan.collectLeaves().size())]
    assert any("included_tax" in s for s in read) and not any("barcodes" in s for s in read)


@pytest.mark.parametrize("records", [pos_raw.square_orders, pos_raw.omnivore_tickets])
def test_a_records_struct_is_made_outside_the_explode(spark, records):
    """Spark interprets what an explode evaluates and compiles what a projection does."""
    plan = records(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    unnested = [line for line in plan if "Generate explode" in line]
    assert unnested and not any("struct(" in line for line in unnested)


def test_payments_of_orders_read_no_lines(spark):
    t = Tables(spark, FOLDER)
    made = pos_raw.square_payments(t)
    assert "l_orderkey" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert made.count() == t.read("orders").count()


def toast_text(order, closed, lines, second=None):
    checks = [ls and {"totalAmount": 9.0, "selections": [x and {"guid": x[0], "item": {"guid": x[1]}, "quantity": 1.0, "price": x[2]} for x in ls]} for ls in (lines, second) if ls is not None]
    return json.dumps({"guid": order, "closedDate": closed and f"{closed}.000+0000", "checks": checks or None})


def parbrink_text(order, closed, lines, second=None):
    entries = None if lines is None else [x and {"Id": x[0], "ItemId": x[1], "GrossSales": x[2]} for x in lines + (second or [])]
    return json.dumps({"Id": order, "BusinessDate": closed, "ModifiedTime": closed and f"{closed}Z", "Total": "9", "Entries": entries})


def simphony_text(order, closed, lines, second=None):
    sold = None if lines is None else [x and {"lineNum": x[0], "aggTtl": str(x[2]), "menuItem": {"miNum": x[1]}, "tenderMedia": {"tmedNum": f"t{x[2]}"}} for x in lines + (second or [])]
    return json.dumps({"chkNum": order, "opnBusDt": closed and closed[:10], "opnUTC": closed and f"{closed}Z", "detailLines": sold})


@pytest.mark.parametrize("profile, kind, text, place", [
    (pos.toast, "orders", toast_text, "location_id"), (pos.parbrink, "orders", parbrink_text, "location_id"), (pos.simphony, "guestChecks", simphony_text, "loc_ref"),
])
def test_stored_orders_are_those_of_all_their_lines(spark, tmp_path, profile, kind, text, place):
    """Orders that come once pass unreduced from a landing or stored text; replayed, restated, nameless ones and repeated lines are reduced."""
    one, two = "2024-01-01T10:00:00", "2024-01-02T10:00:00"
    records = [
        ("once", "s1", one, [("u1", "a", 1.0), ("u2", "b", 2.0), ("u3", "a", 3.0)], [("u4", "a", 1.0)]), ("once", "s2", one, [("u1", "a", 5.0)]),
        ("lines", "s1", one, [("u1", "a", 2.0), ("u1", "a", 1.0), (None, None, 4.0), (None, None, 3.0)]), ("checks", "s1", one, [("u1", "a", 2.0)], [("u1", "a", 1.0)]),
        ("again", "s1", one, [("u1", "a", 1.0)]), ("again", "s1", one, [("u1", "a", 0.5), ("u2", "c", 7.0)]), ("moved", "s1", one, [("u1", "a", 1.0)]), ("moved", "s1", two, [("u1", "a", 2.0)]),
        (None, "s1", one, [("u1", "a", 1.0)]), (None, "s1", one, [("u1", "a", 0.5)]), ("untimed", "s1", None, [("u1", "a", 1.0)]), ("empty", "s1", one, []), ("none", "s1", one, None),
        ("hole", "s1", one, [None, ("u1", "a", 1.0)]),
    ] + [("replay", "s3", one, [("u1", "a", 1.0), ("u2", "b", 2.0)])] * 20
    others = {"dining-options": "{}", "destinations": "{}", "tenders": "{}"}
    data = [(kind, text(r[0], *r[2:]), "2024-01-01", r[1]) for r in records] + [(k, v, "2024-01-01", "s1") for k, v in others.items()] + [(kind, "{broken", "2024-01-01", "s1")]
    raw = spark.createDataFrame(data, f"record_type string, record_value string, feed_date string, {place} string")
    store = TypedLanding(spark, str(tmp_path), profile.LANDING)
    store.land(raw, "2024-01-01")
    if profile is pos.simphony:
        want, found = profile.orders(raw, "p", "2024-01-01"), [profile.orders(store, "p", "2024-01-01")]
    else:
        known = spark.createDataFrame([("once", "s1", ["i1"]), ("again", "s1", ["i2", "i3"]), ("replay", "s3", ["i4"])], "ord_id string, location_id string, identity_ids array<string>")
        want = profile.orders(raw, known, "p", "2024-01-01")
        found = [profile.orders(store, known, "p", "2024-01-01"), profile.orders(raw, known, "p", "2024-01-01", stored=True)]
    assert want.filter("ord_id = 'once'").count() == 5 and want.filter("ord_id = 'replay'").count() == 2
    for got in found:
        assert got.schema == want.schema and rows(got) == rows(want)
    if profile is pos.parbrink:
        assert rows(profile.payments(raw, "p", "2024-01-01", stored=True)) == rows(profile.payments(raw, "p", "2024-01-01"))


def test_lines_of_a_landed_check_are_not_shuffled(spark):
    """Those of checks that come once: the plan above them has no aggregation of lines."""
    plan = q_landed.q_simphony(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    once = next(i for i, line in enumerate(plan) if "LeftAnti" in line)
    above = [line.lstrip(" :+-").split()[0] for line in plan[:once] if not line.lstrip(" :+-").startswith("Project")]
    assert above == ["Union", "Generate"]


@pytest.mark.parametrize("query", [q_landed.q_toast, toast.q_orders, square.q_orders, parbrink.q_orders])
def test_whole_orders_meet_their_identities(spark, query):
    """Lines of orders that come once are unnested above the join with identities, and no aggregation is above it."""
    plan = query(Tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    once = next(i for i, line in enumerate(plan) if "LeftAnti" in line)
    above = [line.lstrip(" :+-").split()[0] for line in plan[:once]]
    assert "Aggregate" not in above and above.index("Generate") < above.index("Join")


def test_orders_are_not_shuffled_to_their_destinations(spark):
    """The few destinations are stored, so that their size is known before the join is planned."""
    orders = parbrink.q_orders(Tables(spark, FOLDER))
    assert any("tillwork-destinations" in f for f in orders.inputFiles())
    assert "BroadcastHashJoin [location_id" in orders._jdf.queryExecution().executedPlan().toString()
