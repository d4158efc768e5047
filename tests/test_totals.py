import datetime as dt
import random

import pytest
from conftest import rows

from tillwork.operators import signals as sig

DAY0 = dt.date(2022, 1, 1)


def feed(spark, rng, days):
    data = []
    for _ in range(300):
        key = (f"c{rng.randrange(6)}", f"p{rng.randrange(2)}", rng.choice(["l1", "ALL"]), "order_metrics", rng.choice(["total_orders", "total_amount"]))
        data.append((*key, DAY0 + dt.timedelta(days=rng.randrange(days)), rng.choice([1, 2, 5, -2])))
    schema = "customer_360_id string, partner_id string, location_id string, signal_domain string, signal_name string, ord_date date, signal_value long"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("at", [0, 40, 150, 400])
def test_periods_from_totals_equal_a_scan(spark, at):
    daily = feed(spark, random.Random(at), 160)
    date = (DAY0 + dt.timedelta(days=at)).isoformat()
    totals, before, held = None, None, None
    for day in sorted([*sig.edge_days(date).values(), date]):
        held = sig.extend_totals(held, daily, day, before)
        totals, before = held if totals is None else totals.unionByName(held), day
    found = sig.period_signals_from_totals(totals, date)
    want = sig.period_signals(daily, date)
    assert rows(found.select(*want.columns)) == rows(want)


def test_only_five_days_are_read(spark, tmp_path):
    daily = feed(spark, random.Random(1), 100)
    path, before = str(tmp_path / "totals"), None
    for i in range(91, 100):  # a day at a time
        day = (DAY0 + dt.timedelta(days=i)).isoformat()
        held = None if before is None else spark.read.parquet(f"{path}/as_of={before}")
        sig.extend_totals(held, daily, day, before).write.mode("append").partitionBy("as_of").parquet(path)
        before = day
    assert rows(spark.read.parquet(f"{path}/as_of={before}")) == rows(sig.extend_totals(None, daily, before).drop("as_of"))
    plan = sig.period_signals_from_totals(spark.read.parquet(path), before)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [as_of" in plan and "PartitionFilters: []" not in plan
