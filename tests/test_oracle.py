"""A share of the registered queries against their oracle SQL at sf0.001; check_oracle.py runs all."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from tillwork.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = """
completed_orders_by_location total_market_insights food_item_filter partner_item_insights item_universe_merge partner_category_insights
snapshot_changes collapse_changes offset_next_range offset_commit merge_conditional merge_partial_update overwrite_where
conform_codes_text conform_channel parse_timestamps to_local_time pseudonymise_columns pseudonymise_json pseudonymise_json_text privacy_lookup_dedup privacy_lookup_upsert full_scan_source union_change_sources incremental_run
metric_tender signals_grouping_sets period_signals rfm_loyalty loyalty_types item_category_match related_identities identity_edges demographic_identities
connected_components customer360_merge geo_prefilter geo_overlap geo_order_interval_join geo_confidence market_feed_categorise
total_market_from_feed person_emails validate_codes demographic_signals latest_weekly_signals generic_profile partner_location_profile
export_search_profile explode_records_wide route_text_toast split_device_ping locations_square items_square customers_square
identities_toast orders_omnivore payments_parbrink customers_parbrink orders_simphony stream_market_insights stream_emptied_days period_signals_write signal_partition_write geo_overlap_merge person_attributes_merge
""".split()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, duck, name):
    verdict, count, _, note = compare(spark, duck, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict == "same", note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


LAZY = [
    "partner_item_insights", "partner_category_insights", "collapse_changes", "merge_conditional", "preaggr_signals", "loyalty_types", "identity_edges",
    "privacy_lookup_dedup", "customers_parbrink", "identities_toast", "orders_parbrink", "geo_order_interval_join", "market_feed_categorise", "item_category_match",
]


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_nested_loop_or_cartesian_join(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
