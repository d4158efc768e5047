"""What grows with the product of pings and orders is neither shuffled nor made more often than needed."""

import pytest

from tillwork.plans import load_all, q_geo
from tillwork.plans.bindings import Tables

load_all()
FOLDER = "/root/testdata/sf0.001"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("query, most", [(q_geo.q_confidence, 0), (q_geo.q_geo_edges, 0), (q_geo.q_identities, 1)])
def test_stored_links_meet_their_totals_without_a_shuffle(spark, query, most):
    """The identities are told apart, which is one shuffle of devices."""
    assert shuffles(query(Tables(spark, FOLDER))) <= most


def joins_of_pairs(df):
    """Joins of orders and visits, by the condition on the time of an order."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Join" in line and "ord_timestamp" in line and "_until" in line for line in plan.split("\n"))


def test_days_to_replace_are_found_without_pairs(spark):
    """Once for the days that stay and once for those replaced, each from orders that come once and several times."""
    assert joins_of_pairs(q_geo.q_replace(Tables(spark, FOLDER))) <= 4


def test_devices_of_an_order_are_counted_without_pairs(spark):
    """Pairs of orders that come once are joined for the result only: in each of its halves a join for it and one for the count of repeated orders."""
    assert joins_of_pairs(q_geo.q_score(Tables(spark, FOLDER))) <= 4


def test_few_totals_are_broadcast_whatever_the_threshold(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(q_geo.q_confidence(Tables(spark, FOLDER))) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
