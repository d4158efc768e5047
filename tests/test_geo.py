import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwork.operators import geo
from tillwork.plans import load_all, q_geo
from tillwork.plans.bindings import Tables
from tillwork.session import stored_once, tuned
from tillwork.sources.ping_store import PingStore

load_all()

R = 6378137.0


def xy(lat, lon):
    return R * math.radians(lon), R * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))


def degrees(x, y):
    return math.degrees(2 * math.atan(math.exp(y / R)) - math.pi / 2), math.degrees(x / R)


def stores(spark, points):
    df = spark.createDataFrame(
        [("p", f"s{i}", str(lat), str(lon), "1") for i, (lat, lon) in enumerate(points)] + [("p", "shut", "1", "1", "0"), ("p", "blank", "", "1", "1")],
        "partner_id string, location_id string, lat string, long string, active_flg string",
    )
    return geo.geo_project(df)


def test_prefilter_keeps_every_point_in_a_box(spark):
    rng = random.Random(6)
    for _ in range(4):
        half = rng.choice([50.0, 5_000.0, 80_000.0])
        points = [(rng.uniform(-70, 70), rng.uniform(-170, 170)) for _ in range(rng.randint(1, 10))]
        inside, anywhere = [], [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(300)]
        for lat, lon in points:
            x, y = xy(lat, lon)
            inside += [degrees(x + rng.uniform(-0.999, 0.999) * half, y + rng.uniform(-0.999, 0.999) * half) for _ in range(20)]
        pings = spark.createDataFrame(inside + anywhere, "latitude double, longitude double")
        kept = {tuple(r) for r in pings.filter(geo.geo_prefilter(stores(spark, points), half, 3)).collect()}
        assert set(inside) <= kept
        if len(points) > 1 and half < 1000:
            assert len(kept) < len(inside) + len(anywhere)


def test_prefilter_without_stores_keeps_all(spark):
    pings = spark.createDataFrame([(1.0, 2.0)], "latitude double, longitude double")
    assert pings.filter(geo.geo_prefilter(stores(spark, []), 100.0)).count() == 1


def test_overlap_equals_brute_force(spark):
    rng = random.Random(7)
    points = [(40 + rng.uniform(0, 0.02), -74 + rng.uniform(0, 0.02)) for _ in range(12)]
    pings = [(str(1_600_000_000 + i), 40 + rng.uniform(-0.01, 0.03), -74 + rng.uniform(-0.01, 0.03), float(rng.randint(0, 60)), "MAID-AAID", f"d{i}", None) for i in range(600)]
    df = spark.createDataFrame(
        pings, "utc_timestamp string, latitude double, longitude double, horizontal_accuracy double, id_type string, advertiser_id_AAID string, advertiser_id_IDFA string"
    )
    expected = sorted(
        (f"s{i}", p[5])
        for p in pings if p[3] <= 50
        for i, s in enumerate(points)
        if math.dist(xy(p[1], p[2]), xy(*s)) <= p[3] * 2 + 300
    )
    for gaps in (5, 0, None):
        found = geo.geo_overlap(df, stores(spark, points), 50.0, 300.0, 2.0, max_gaps=gaps)
        assert rows(found.select("location_id", "maid")) == expected and len(expected) > 50


def test_no_match_at_the_edge_of_the_box_is_lost(spark):
    """A ping exactly as far as the largest threshold, straight along either axis."""
    x, y = xy(40.0, -74.0)
    limit = 50.0 * 2 + 300
    pings = [degrees(x + dx * limit * 0.9999999, y + dy * limit * 0.9999999) for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    df = spark.createDataFrame(
        [("1600000000", lat, lon, 50.0, "MAID-AAID", f"d{i}", None) for i, (lat, lon) in enumerate(pings)],
        "utc_timestamp string, latitude double, longitude double, horizontal_accuracy double, id_type string, advertiser_id_AAID string, advertiser_id_IDFA string",
    )
    assert geo.geo_overlap(df, stores(spark, [(40.0, -74.0)]), 50.0, 300.0, 2.0).count() == 4


def test_prefilter_reaches_the_parquet_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "pings")
    spark.createDataFrame([(40.0, -74.0), (10.0, 10.0)], "latitude double, longitude double").write.parquet(path)
    kept = spark.read.parquet(path).filter(geo.geo_prefilter(stores(spark, [(40.0, -74.0)]), 100.0))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(latitude" in plan and "LessThanOrEqual(longitude" in plan
    assert kept.count() == 1


PING = "utc_timestamp string, latitude double, longitude double, horizontal_accuracy double, id_type string, advertiser_id_AAID string, advertiser_id_IDFA string"


def test_stored_pings_give_every_match(spark, tmp_path):
    """Stores at the edges and corners of areas, pings on both sides, without a place and at the poles; two writes."""
    rng = random.Random(11)
    side = 100_000.0
    points = [degrees(i * side + dx, j * side + dy) for i, j in ((0, 0), (-3, 7), (5, -2)) for dx, dy in ((0, 0), (300, 0.5), (-0.5, 200), (40_000, 40_000))]
    place = [degrees(x + rng.uniform(-450, 450), y + rng.uniform(-450, 450)) for x, y in (xy(*p) for p in points) for _ in range(40)]
    place += [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(200)]
    place += [(None, 1.0), (1.0, None), (90.0, 0.0), (-90.0, 0.0), (float("nan"), 0.0), (0.0, float("inf")), (89.9, 180.0)]
    pings = spark.createDataFrame([(str(1_600_000_000 + i), lat, lon, float(i % 60), "MAID-AAID", f"d{i}", None) for i, (lat, lon) in enumerate(place)], PING)
    store = PingStore(str(tmp_path / "pings"), side)
    store.write(pings.limit(300))
    store.write(pings.join(pings.limit(300), "utc_timestamp", "left_anti").select(pings.columns))
    assert rows(store.read(spark).select("utc_timestamp")) == rows(pings.select("utc_timestamp"))
    known = stores(spark, points)
    expected = rows(geo.geo_overlap(pings, known, 50.0, 300.0, 2.0))
    for gaps in (None, 3):
        assert rows(store.overlap(known, 50.0, 300.0, 2.0, gaps)) == expected and len(expected) > 300
    assert store.overlap(stores(spark, []), 50.0, 300.0, 2.0).count() == 0
    with pytest.raises(ValueError, match="50 km"):
        PingStore("x", 10.0)


def test_areas_without_a_store_are_not_read(spark, tmp_path):
    """The stores prune partitions while the query runs; the boxes decide it, not a job before."""
    pings = spark.range(4000).select(
        F.col("id").cast("string").alias("utc_timestamp"), (F.col("id") % 40 - 20).cast("double").alias("latitude"), (F.col("id") % 50).cast("double").alias("longitude"),
        F.lit(10.0).alias("horizontal_accuracy"), F.lit("MAID-AAID").alias("id_type"), F.lit("d").alias("advertiser_id_AAID"), F.lit(None).cast("string").alias("advertiser_id_IDFA"),
    )
    store = PingStore(str(tmp_path / "pings"))
    store.write(pings)
    folder = str(tmp_path / "stores")
    stores(spark, [(5.0, 5.0)]).write.parquet(folder)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "")
    found = store.overlap(spark.read.parquet(folder), 50.0, 300.0, 2.0)
    listed = set(jobs.getJobIdsForGroup("plan"))
    execution = found._jdf.queryExecution()
    assert "dynamicpruning" in execution.executedPlan().toString() and set(jobs.getJobIdsForGroup("plan")) == listed
    found.collect()
    scans = [s for s in leaves(execution.executedPlan()) if "pings" in s.toString() and s.metrics().contains("numFiles")]
    assert len(scans) == 1 and scans[0].metrics().apply("numPartitions").value() <= 2
    assert scans[0].metrics().apply("numOutputRows").value() <= 4000 / 100
    assert found.count() == 20


def leaves(plan):
    """The leaf nodes of an executed plan, also below adaptive stages."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return leaves(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return leaves(plan.plan())
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    return [leaf for b in below for leaf in leaves(b)] if below else [plan]


def orders_and_visits(spark, seed=12):
    """Orders (some several times, other dates, no customer, no place) and repeated sightings of few devices, with times at the edges of the interval."""
    rng = random.Random(seed)
    base, owners = 1_600_000_000, [None, [("email", "a")], [("email", "a"), ("phone", "b")], [("email", "c"), ("card", "x")]]
    orders = [
        (rng.choice("pq"), rng.choice(["s", "t"]), f"o{rng.randint(0, 25)}" if i else None, f"2020-09-{rng.randint(10, 14)}", base + 1800 * rng.randint(-60, 60), rng.choice(owners))
        for i in range(50)
    ]
    orders.append((None, "s", "o1", "2020-09-10", base, owners[1]))
    pings = [(rng.choice("pq"), rng.choice(["s", "t"]), rng.choice([None, "d1", "d2", "d3"]), rng.choice(["A", "B"]), base + 1800 * rng.randint(-90, 90)) for _ in range(120)]
    pings.append(("p", "s", "d1", "A", None))
    frame = spark.createDataFrame(orders, "partner_id string, location_id string, ord_id string, d string, s bigint, identity_ids array<struct<identity_type:string,identity_id:string>>")
    seen = spark.createDataFrame(pings, "partner_id string, location_id string, maid string, maid_type string, s bigint")
    frame = frame.select("partner_id", "location_id", "ord_id", F.col("d").cast("date").alias("ord_date"), F.timestamp_seconds("s").alias("ord_timestamp"), "identity_ids")
    return orders, pings, frame, seen.select("partner_id", "location_id", "maid", "maid_type", F.timestamp_seconds("s").alias("geo_timestamp"))


def met(orders, pings, interval):
    """(partner, location, order, device, type): smallest date of a matching order row."""
    found = {}
    for p, loc, o, d, s, _ in orders:
        for q, at, maid, kind, seen in pings:
            if p is not None and seen is not None and (p, loc) == (q, at) and abs(s - seen) <= interval:
                key = (p, loc, o, maid, kind)
                found[key] = min(d, found.get(key, d))
    return found


def test_interval_join_equals_brute_force(spark):
    for seed, interval in ((12, 12 * 3600), (13, 1800), (14, 3601)):
        orders, pings, frame, seen = orders_and_visits(spark, seed)
        expected = met(orders, pings, interval)
        joined = geo.geo_order_interval_join(frame, seen, interval, count_devices=True)
        got = joined.select("partner_id", "location_id", "ord_id", "maid", "maid_type", F.col("ord_date").cast("string")).collect()
        assert len(got) == len(expected) > 20 and {tuple(r)[:5]: r.ord_date for r in got} == expected
        plain = geo.geo_order_interval_join(frame, seen, interval)
        assert rows(geo.geo_device_score(joined).drop("identity_ids")) == rows(geo.geo_device_score(plain).drop("identity_ids"))


def test_links_by_order_equal_links_by_pair(spark):
    _, _, frame, seen = orders_and_visits(spark)
    frame = frame.dropDuplicates(["partner_id", "location_id", "ord_id"])
    customers = spark.createDataFrame(
        [("c1", {"email": ["a"], "phone": ["b"]}, True), ("c2", {"phone": ["b"], "email": ["c"]}, True), ("c3", {"email": ["a"]}, False)],
        "customer_360_id string, identities map<string,array<string>>, active_flag boolean",
    )
    plain = geo.geo_customer_link(geo.geo_device_score(geo.geo_order_interval_join(frame, seen, 7200)), customers)
    known = geo.with_order_customers(geo.orders_near(frame, seen, 7200), customers)
    pairs = geo.geo_order_interval_join(known, seen, 7200, carry=("customer_360_ids",), count_devices=True)
    found = geo.geo_customer_link(geo.geo_device_score(pairs), customers)
    score = F.round("profile_maid_link_score", 9).alias("score")
    columns = ["maid", "maid_type", "customer_360_id", "frequency_linked", score]
    assert rows(found.select(columns)) == rows(plain.select(columns)) and found.count() > 5


def test_pairs_of_orders_and_devices_are_not_shuffled(spark):
    """40 orders met by 250 devices each, seen twice: what is shuffled stays far below the 10,000 pairs."""
    orders = spark.range(40).select(
        F.lit("p").alias("partner_id"), F.lit("s").alias("location_id"), F.col("id").cast("string").alias("ord_id"), F.lit("2020-09-13").cast("date").alias("ord_date"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id")).alias("ord_timestamp"), F.lit(None).cast("array<struct<identity_type:string,identity_id:string>>").alias("identity_ids"),
    )
    seen = spark.range(500).select(
        F.lit("p").alias("partner_id"), F.lit("s").alias("location_id"), (F.col("id") % 250).cast("string").alias("maid"), F.lit("A").alias("maid_type"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id")).alias("geo_timestamp"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = geo.geo_device_score(geo.geo_order_interval_join(orders, seen, 3600, count_devices=True))
        assert len(scored.collect()) == 10_000
        written = shuffled(scored._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert written and max(written) <= 1000


def shuffled(plan):
    """Rows written by each shuffle of an executed plan, also below adaptive stages."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    own = [plan.metrics().apply("shuffleRecordsWritten").value()] if kind == "ShuffleExchangeExec" else []
    return own + [w for i in range(plan.children().size()) for w in shuffled(plan.children().apply(i))]


@pytest.mark.parametrize("copies", [False, True])
def test_links_of_blocks_equal_links_by_pair(spark, monkeypatch, copies):
    """Stored orders and visits in several blocks of devices, with and without orders that come several times."""
    monkeypatch.setattr(geo, "PAIRS_PER_BLOCK", 3)
    _, _, frame, seen = orders_and_visits(spark)
    if not copies:
        frame = frame.dropDuplicates(["partner_id", "location_id", "ord_id"])
    frame = frame.withColumn("customer_360_ids", F.array(F.concat(F.lit("c"), F.length("ord_id")), F.lit("all"))).withColumn("identity_ids", F.lit(None).cast(frame.schema["identity_ids"].dataType))
    joined = [geo.geo_order_interval_join(frame, seen, 7200, ("customer_360_ids",), True, keep) for keep in (None, lambda df: stored_once(df, "geo"))]
    order = ["partner_id", "location_id", "ord_id", "ord_date", "maid", "maid_type", "devices"]
    assert rows(joined[1].select(order)) == rows(joined[0].select(order)) and joined[1].select(geo.BLOCK).distinct().count() > 3
    score = F.round("profile_maid_link_score", 9).alias("score")
    plain, found = (geo.geo_customer_link(geo.geo_device_score(j), None).select("maid", "maid_type", "customer_360_id", "frequency_linked", score) for j in joined)
    assert rows(found) == rows(plain) and found.count() > 5


def test_links_are_counted_where_their_pairs_are_made(spark):
    """Only visits and orders are shuffled, by blocks of devices; neither pairs nor links are."""
    plan = q_geo.links(Tables(tuned(spark), "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    tuned(spark)
    dealt = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(dealt) == 2 and all("hashpartitioning(device_block" in line and "REPARTITION_BY_NUM" in line for line in dealt)


def test_stores_seen_do_not_shuffle_the_orders(spark):
    _, _, frame, seen = orders_and_visits(spark)
    plan = geo.orders_near(frame, seen, 7200, lambda df: stored_once(df, "seen"))
    assert rows(plan.select("ord_id")) == rows(geo.orders_near(frame, seen, 7200).select("ord_id"))
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
