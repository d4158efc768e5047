import random

import pytest
from conftest import rows

from tillwork.operators import component_updates, components
from tillwork.operators import identity_graph as ig
from tillwork.operators.component_updates import plain_edges, update_components, update_edges
from tillwork.operators.components import connected_components, star_components


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return sorted((n, root(n)) for n in nodes)


def graphs():
    rng = random.Random(5)
    nodes = [f"n{i:03d}" for i in range(120)]
    yield "random", nodes, [(rng.choice(nodes), rng.choice(nodes)) for _ in range(90)]
    yield "star", nodes, [("n060", n) for n in nodes if n != "n060"]
    yield "path", nodes[:70], list(zip(nodes, nodes[1:70]))
    yield "none", nodes[:5], []


@pytest.mark.parametrize("name, nodes, edges", list(graphs()), ids=lambda v: v if isinstance(v, str) else "")
def test_components_equal_union_find(spark, name, nodes, edges):
    vertices = spark.createDataFrame([(n,) for n in nodes], "id string")
    links = spark.createDataFrame(edges, "src string, dst string")
    assert rows(connected_components(vertices, links)) == union_find(nodes, edges)


CUSTOMER = "customer_360_id string, identities map<string,array<string>>, create_date date, update_date date, active_flag boolean"
D1, D2, TODAY = "2020-01-01", "2020-02-02", "2022-05-05"


def customers(spark, *people):
    import datetime as dt

    return spark.createDataFrame(
        [(c, {"email": ids}, dt.date.fromisoformat(d), dt.date.fromisoformat(d), active) for c, ids, d, active in people], CUSTOMER
    )


def reconcile(spark, components, *people):
    comps = spark.createDataFrame([(f"email:{i}", f"email:{min(group)}") for group in components for i in group], "qualified_identity string, component_id string")
    previous = customers(spark, *people)
    result = ig.customer360_deactivate(previous, ig.customer360_update(comps, previous, TODAY))
    return {(r.customer_360_id if len(r.customer_360_id) < 10 else "new", tuple(r.identities["email"]), str(r.create_date), r.active_flag) for r in result.collect()}


def test_new_customer(spark):
    assert reconcile(spark, [["a", "b"]]) == {("new", ("a", "b"), TODAY, True)}


def test_expanded_customer_keeps_its_id(spark):
    assert reconcile(spark, [["a", "b", "c"]], ("x", ["a", "b"], D1, True)) == {("x", ("a", "b", "c"), D1, True)}


def test_merged_customers_keep_the_oldest_id(spark):
    people = (("x", ["a", "b"], D2, True), ("y", ["c", "d"], D1, True))
    assert reconcile(spark, [["a", "b", "c", "d"]], *people) == {("y", ("a", "b", "c", "d"), D1, True), ("x", ("a", "b"), D2, False)}


def test_split_customer_keeps_its_id_on_the_larger_part(spark):
    found = reconcile(spark, [["a"], ["b", "c"]], ("x", ["a", "b", "c"], D1, True))
    assert found == {("new", ("a",), TODAY, True), ("x", ("b", "c"), D1, True)}


def test_exact_half_is_not_enough(spark):
    found = reconcile(spark, [["a", "b"], ["c", "d"]], ("x", ["a", "b", "c", "d"], D1, True))
    assert found == {("new", ("a", "b"), TODAY, True), ("new", ("c", "d"), TODAY, True), ("x", ("a", "b", "c", "d"), D1, False)}


def test_part_that_lost_its_id_never_gets_it_back(spark):
    """The smallest identity's own digest must not equal the id its former customer carries on."""
    comps = spark.createDataFrame([("email:a", "email:a")], "qualified_identity string, component_id string")
    first = ig.customer360_update(comps, customers(spark), TODAY).first()
    grown = customers(spark, (first.customer_360_id, ["a", "b", "c"], D1, True))
    split = spark.createDataFrame([("email:a", "email:a"), ("email:b", "email:b"), ("email:c", "email:b")], "qualified_identity string, component_id string")
    ids = [r[0] for r in ig.customer360_update(split, grown, TODAY).select("customer_360_id").collect()]
    assert len(set(ids)) == 2 and first.customer_360_id in ids


def test_edges_drop_when_frequency_falls_to_zero(spark):
    import datetime as dt

    def edges(f):
        day = dt.date(2022, 1, 1)
        return spark.createDataFrame(
            [("a", "email", "b", "phone", "posRelated", f, day, day, True)],
            "source string, source_type string, target string, target_type string, relationship string, frequency int, created_date date, last_seen_date date, active_flag boolean",
        )

    assert ig.identity_edges_merge(edges(2), edges(-1)).first().frequency == 1
    assert ig.identity_edges_merge(edges(1), edges(-1)).count() == 0


def batches():
    rng = random.Random(11)
    nodes = [f"n{i:03d}" for i in range(90)]
    stored = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(70)]
    yield "random", nodes, stored, [(rng.choice(nodes), rng.choice(nodes)) for _ in range(15)] + [("z1", "n005"), ("z2", "z3"), ("z4", "z4")], rng.sample(stored, 12) + [("n000", "n089"), ("x", "y")]
    chain = list(zip(nodes, nodes[1:]))
    yield "cut and tied again", nodes, chain, [("n010", "n070"), chain[40]], [chain[30], chain[40]]
    yield "merged chain", nodes, [e for i, e in enumerate(chain) if i % 3], [e for i, e in enumerate(chain) if i % 3 == 0], []
    yield "star loses its hub", nodes, [("n050", n) for n in nodes if n != "n050"], [("n001", "n002")], [("n050", n) for n in nodes[:45]]
    yield "nulls", nodes[:9], chain[:4], [(None, "n001"), ("n008", None), ("n007", "n008")], [(None, None), ("n001", None)]


@pytest.mark.parametrize("name, nodes, stored, inserted, deleted", list(batches()), ids=lambda v: v if isinstance(v, str) else "")
def test_updated_components_equal_a_full_run(spark, name, nodes, stored, inserted, deleted):
    def links(pairs):
        return spark.createDataFrame(pairs, "src string, dst string")

    vertices = spark.createDataFrame([(n,) for n in nodes], "id string")
    edges = plain_edges(links(stored))
    labels = connected_components(vertices, edges)
    found = update_components(labels, edges, links(inserted), links(deleted))
    after = update_edges(edges, links(inserted), links(deleted))
    assert rows(found) == rows(connected_components(vertices, after))
    whole = {tuple(sorted(e)) for e in inserted if None not in e and e[0] != e[1]}
    kept = {tuple(sorted(e)) for e in stored if e[0] != e[1]} - {tuple(sorted(e)) for e in deleted if None not in e}
    assert rows(after) == sorted(kept | whole)


def test_batches_one_after_the_other(spark):
    """Random batches on stored labels give at every step what a full run gives."""
    rng = random.Random(12)
    nodes = list(range(60))
    edges = plain_edges(spark.createDataFrame([(rng.choice(nodes), rng.choice(nodes)) for _ in range(40)], "src int, dst int"))
    labels = connected_components(spark.createDataFrame([(n,) for n in nodes], "id int"), edges)
    for step in range(2):
        now = rows(edges)
        inserted = [(rng.choice(nodes), rng.choice([*nodes, 100 + step])) for _ in range(rng.randrange(6))]
        deleted = rng.sample(now, min(len(now), rng.randrange(8)))
        new, gone = (spark.createDataFrame(pairs, "src int, dst int") for pairs in (inserted, deleted))
        labels, edges = update_components(labels, edges, new, gone), update_edges(edges, new, gone)
        labels, edges = (spark.createDataFrame(rows(df), df.schema) for df in (labels, edges))
        assert rows(labels) == rows(connected_components(labels.select("id"), edges))


def test_rounds_read_the_reopened_component_only(spark, monkeypatch):
    """Of a long list of components, the star rounds see the one that lost an edge and the labels that an edge ties."""
    edges = plain_edges(spark.createDataFrame([(10 * c + i, 10 * c + i + 1) for c in range(200) for i in range(5)], "src int, dst int"))
    labels = connected_components(spark.createDataFrame([], "id int"), edges)
    seen = []
    monkeypatch.setattr(component_updates, "star_components", lambda e: seen.append(rows(e)) or star_components(e))
    found = update_components(labels, edges, spark.createDataFrame([(33, 79)], "src int, dst int"), spark.createDataFrame([(1002, 1003)], "src int, dst int"))
    assert seen == [[(1000, 1001), (1001, 1002), (1003, 1004), (1004, 1005)], [(30, 79)]]
    after = {r["id"]: r["component_id"] for r in found.collect()}
    assert after[1005] == 1003 and after[35] == after[79] == 30 and after[31] == 30 and len(after) == 1201


def test_a_hub_is_split(spark):
    """Half of all edges at one node: the join that gives each its smallest neighbour reads the hub in parts."""
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        links = spark.range(40000).selectExpr("if(id % 2 = 0, 0, id) AS u", "id + 100000 AS v").repartition(6)
        stars = components._large_star(links)
        stars.collect()
        assert "skew=true" in stars._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
