"""Records that a query reads several times are made once, whatever reads them."""

import pytest

from tillwork.plans import load_all, pos_raw, q_profile
from tillwork.plans import q_pos_parbrink as parbrink
from tillwork.plans import q_pos_square as square
from tillwork.plans import q_pos_toast as toast
from tillwork.plans.bindings import Tables

load_all()
FOLDER = "/root/testdata/sf0.001"


def scans(df, table):
    plan = df._jdf.queryExecution().optimizedPlan()
    return sum(f"/{table}.parquet" in str(f) for leaf in _leaves(plan) for f in _files(leaf))


def _leaves(plan):
    return [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]


def _files(leaf):
    return [f for f in leaf.relation().location().inputFiles()] if hasattr(leaf, "relation") else []


@pytest.mark.parametrize("query, most", [(toast.q_identities, 0), (toast.q_orders, 1), (parbrink.q_orders, 0)])
def test_lines_are_read_for_the_stored_records_only(spark, query, most):
    assert scans(query(Tables(spark, FOLDER)), "lineitem") <= most


def test_stored_records_are_the_records(spark):
    t = Tables(spark, FOLDER)
    made = pos_raw.toast_orders(t)
    kept = pos_raw.stored(t, made).select(made.columns)
    assert kept.exceptAll(made).count() == 0 and made.exceptAll(kept).count() == 0


def test_identities_are_found_once_for_all_partition_writes(spark, monkeypatch):
    written = []
    write = square.identity_partition_write
    monkeypatch.setattr(square, "identity_partition_write", lambda rows, *more: (written.append(scans(rows, "lineitem")), write(rows, *more)))
    assert scans(square.q_identities(Tables(spark, FOLDER)), "lineitem") > 0
    square.q_partition_write(Tables(spark, FOLDER))
    assert written == [0, 0, 0]


def test_period_signals_are_computed_once_for_all_writes(spark, monkeypatch):
    written = []
    for name in ("replace_partitions", "replace_within"):
        write = getattr(q_profile, name)
        monkeypatch.setattr(q_profile, name, lambda rows, *more, write=write: (written.append(scans(rows, "orders")), write(rows, *more)))
    q_profile.q_period_write(Tables(spark, FOLDER))
    assert written == [0, 0]
