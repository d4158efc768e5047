"""Queries of the identity graph, the demographic feeds and customer_360."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import codes
from tillwork.functions.fields import qualified_identity
from tillwork.operators import changes as chg
from tillwork.operators import component_updates as cu
from tillwork.operators import identity_graph as ig
from tillwork.operators import privacy
from tillwork.operators.keyed import without_matches
from tillwork.plans.bindings import SALT, Tables
from tillwork.plans.q_fields import CONTACT_VIEWS, RULES, contacts
from tillwork.plans.registry import query

TODAY = "2002-01-01"

# ---- order diff ---------------------------------------------------------------------


def order_version(t: Tables, version: int) -> DataFrame:
    """Version 1 lacks every tenth order; 2 lacks every eleventh and moves every seventh to another customer."""
    k = F.col("o_orderkey")
    moved = F.col("o_custkey") + (k % 7 == 0).cast("int")
    cust = F.col("o_custkey") if version == 1 else moved
    return t.read("orders").filter(k % (10 if version == 1 else 11) != 0).select(
        k.cast("string").alias("ord_id"), F.col("o_orderdate").cast("date").alias("ord_date"), t.identity_array(cust).alias("identity_ids")
    )


def order_diff(t: Tables) -> DataFrame:
    feed = chg.snapshot_changes(order_version(t, 1), order_version(t, 2), ["ord_id"], 2)
    return chg.collapse_changes(feed, ["ord_id"])


EDGE_VIEWS = {
    "w1": "SELECT o_orderkey AS ord_id, o_custkey AS cust, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 10 <> 0",
    "w2": "SELECT o_orderkey AS ord_id, o_custkey + CAST(o_orderkey % 7 = 0 AS INTEGER) AS cust, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 11 <> 0",
    "moved": """SELECT coalesce(w1.ord_id, w2.ord_id) AS ord_id, w1.cust AS c1, w2.cust AS c2, w1.d AS d1, w2.d AS d2
                FROM w1 FULL JOIN w2 ON w1.ord_id = w2.ord_id WHERE w1.cust IS DISTINCT FROM w2.cust""",
    "related": """SELECT ord_id, c1 AS cust, d1 AS d, -1 AS f FROM moved WHERE c1 IS NOT NULL
                  UNION ALL SELECT ord_id, c2, d2, 1 FROM moved WHERE c2 IS NOT NULL""",
    "owners": "SELECT DISTINCT cust FROM (SELECT cust FROM w1 UNION SELECT cust FROM w2)",
    "cust_ids": """SELECT cust, 'email' AS ty, 'c' || cust || '@shop' || (cust % 3) || '.com' AS id FROM owners
                   UNION ALL SELECT cust, 'phone', '1212' || (cust // 3 + 2000000) FROM owners
                   UNION ALL SELECT cust, 'combination-card', 'card' || ((cust + 1) // 3) FROM owners WHERE cust % 12 IN (2, 3)""",
    "cust_pairs": """SELECT a.cust, a.id AS source, a.ty AS source_type, b.id AS target, b.ty AS target_type
                     FROM cust_ids a JOIN cust_ids b ON a.cust = b.cust AND a.id < b.id""",
    "diff_edges": """SELECT source, source_type, target, target_type, sum(f) AS f, min(d) AS d1, max(d) AS d2
                     FROM related JOIN cust_pairs USING (cust) GROUP BY ALL""",
    "base_edges": """SELECT source, source_type, target, target_type, count(*) AS f, min(d) AS d1, max(d) AS d2
                     FROM w1 JOIN cust_pairs USING (cust) GROUP BY ALL""",
}


def edge_sql(source: str) -> str:
    return f"""SELECT source, source_type, target, target_type, 'posRelated' AS relationship, CAST(f AS BIGINT) AS frequency,
                      strftime(d1, '%Y-%m-%d') AS created_date, strftime(d2, '%Y-%m-%d') AS last_seen_date, true AS active_flag FROM ({source})"""


@query("modified_identity_orders", "SELECT CAST(ord_id AS VARCHAR) AS ord_id FROM moved", EDGE_VIEWS)
def q_modified(t: Tables) -> DataFrame:
    return ig.modified_identity_orders(order_diff(t)).select(F.coalesce("previous_record.ord_id", "current_record.ord_id").alias("ord_id"))


@query(
    "related_identities",
    """SELECT CAST(f AS BIGINT) AS frequency, strftime(d, '%Y-%m-%d') AS date,
              (SELECT string_agg(ty || ':' || id, '|' ORDER BY ty <> 'email', ty <> 'phone') FROM cust_ids i WHERE i.cust = related.cust) AS identities FROM related""",
    EDGE_VIEWS,
)
def q_related(t: Tables) -> DataFrame:
    return ig.related_identities(order_diff(t), TODAY).select(
        "frequency", "date", F.array_join(F.transform("identities", lambda i: qualified_identity(i["identity_type"], i["identity_id"])), "|").alias("identities")
    )


@query("identity_edges", edge_sql("SELECT * FROM diff_edges"), EDGE_VIEWS)
def q_edges(t: Tables) -> DataFrame:
    return ig.identity_edges(ig.related_identities(order_diff(t), TODAY))


def first_edges(t: Tables) -> DataFrame:
    return ig.identity_edges(ig.related_identities(chg.snapshot_as_diff(order_version(t, 1)), TODAY))


@query(
    "identity_edges_merge",
    edge_sql("""SELECT source, source_type, target, target_type, coalesce(b.f, 0) + coalesce(d.f, 0) AS f,
                       least(b.d1, d.d1) AS d1, greatest(b.d2, d.d2) AS d2
                FROM base_edges b FULL JOIN diff_edges d USING (source, source_type, target, target_type)
                WHERE b.source IS NULL OR d.source IS NULL OR b.f + d.f > 0"""),
    EDGE_VIEWS,
)
def q_edges_merge(t: Tables) -> DataFrame:
    return ig.identity_edges_merge(first_edges(t), ig.identity_edges(ig.related_identities(order_diff(t), TODAY)))


# ---- identity table -----------------------------------------------------------------


def identity_version(t: Tables, version: int) -> DataFrame:
    k = F.col("c_custkey")
    return t.read("customer").filter(k % (5 if version == 1 else 6) != 0).select(
        F.concat(F.lit("h"), k).alias("identity_id"), F.lit(codes.EMAIL).alias("type"),
        F.when((k % 4 == 0) & F.lit(version == 2), "2").otherwise("3").alias("weight"),
    )


@query(
    "identity_dedup",
    """SELECT 'h' || c_custkey AS identity_id, 'email' AS type,
              CASE WHEN c_custkey % 6 = 0 THEN 'kept' WHEN c_custkey % 4 = 0 OR c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN '2' ELSE '3' END ELSE 'kept' END AS weight
       FROM customer WHERE c_custkey % 6 <> 0 OR c_custkey % 5 = 0""",
)
def q_identity_dedup(t: Tables) -> DataFrame:
    """The stored table holds every customer; the feed goes from version 1 to 2."""
    k = F.col("c_custkey")
    stored = t.read("customer").select(F.concat(F.lit("h"), k).alias("identity_id"), F.lit(codes.EMAIL).alias("type"), F.lit("kept").alias("weight"))
    feed = chg.snapshot_changes(identity_version(t, 1), identity_version(t, 2), ["identity_id", "type"], 2)
    return ig.identity_dedup(stored, chg.collapse_changes(feed, ["identity_id", "type"]))


# ---- demographic feeds --------------------------------------------------------------


def person_devices(t: Tables, odd: int) -> DataFrame:
    """Device rows of every second customer, each twice, on three feed dates."""
    k = F.col("c_custkey")
    rows = t.read("customer").filter(k % 2 == odd).select(
        F.concat(F.lit("tid"), k).alias("person_id"),
        F.when(k % 10 != odd, F.concat(F.lit("maid-"), k)).alias("native_maid"),
        F.date_add(F.lit("2023-12-30").cast("date"), (k % 3).cast("int")).alias("feed_date"),
    )
    return rows.unionByName(rows)


def person_emails(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.read("customer").select(
        F.concat(F.lit("tid"), k).alias("person_id"),
        F.when(k % 7 != 0, F.sha2(F.concat(F.lit("user"), k, F.lit("@mail.com")), 256)).alias("sha256_lower_email"),
    )


def demographic(t: Tables) -> tuple[DataFrame, DataFrame]:
    maids = ig.demographic_maids(ig.latest_feed(person_devices(t, 0)), ig.latest_feed(person_devices(t, 1)))
    _, lookup = privacy.pseudonymise_columns(contacts(t), RULES, SALT)
    return maids, ig.demographic_emails(person_emails(t), lookup)


DEMO_VIEWS = {
    **CONTACT_VIEWS,
    "maids": """SELECT 'tid' || c_custkey AS person_id, 'maid-' || c_custkey AS native_maid,
                       CASE WHEN c_custkey % 2 = 0 THEN 'MAID-IDFA' ELSE 'MAID-AAID' END AS maid_type
                FROM customer WHERE c_custkey % 3 = 2 AND c_custkey % 10 <> c_custkey % 2""",
    "mails": f"""SELECT 'tid' || c_custkey AS person_id, sha256(email || '{SALT}') AS hashed_email FROM contacts_clean
                 WHERE email IS NOT NULL AND c_custkey % 7 <> 0""",
    "demo_edges": """SELECT person_id AS source, 'person-id' AS source_type, native_maid AS target, maid_type AS target_type FROM maids
                     UNION ALL SELECT person_id, 'person-id', hashed_email, 'email' FROM mails""",
    "demo_ids": """SELECT DISTINCT person_id AS identity_id, 'person-id' AS type, NULL AS email_domain FROM (SELECT person_id FROM maids UNION SELECT person_id FROM mails)
                   UNION ALL SELECT native_maid, maid_type, NULL FROM maids UNION ALL SELECT hashed_email, 'email', 'mail.com' FROM mails""",
}


@query(
    "latest_feed",
    "SELECT 'tid' || c_custkey AS person_id, CASE WHEN c_custkey % 10 <> 0 THEN 'maid-' || c_custkey END AS native_maid, '2024-01-01' AS feed_date "
    "FROM customer, (SELECT unnest([1, 2])) WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 2",
)
def q_latest(t: Tables) -> DataFrame:
    return ig.latest_feed(person_devices(t, 0))


@query("demographic_maids", "SELECT * FROM maids", DEMO_VIEWS)
def q_maids(t: Tables) -> DataFrame:
    return demographic(t)[0]


@query("demographic_emails", "SELECT *, 'mail.com' AS email_domain FROM mails", DEMO_VIEWS)
def q_emails(t: Tables) -> DataFrame:
    return demographic(t)[1].select("person_id", "hashed_email", F.element_at("email_metadata", F.lit("email_domain")).alias("email_domain"))


@query("demographic_identities", "SELECT * FROM demo_ids", DEMO_VIEWS)
def q_demo_identities(t: Tables) -> DataFrame:
    """Inserted into a table that knows half of the persons already."""
    maids, emails = demographic(t)
    found = ig.demographic_identities(maids, emails)
    known = found.filter((F.col("type") == codes.PERSON_ID) & (F.col("identity_id").endswith("1")))
    return ig.demographic_identities_merge(known, found).select(
        "identity_id", "type", F.element_at("metadata", F.lit("email_domain")).alias("email_domain")
    )


@query(
    "demographic_edges",
    """SELECT *, 'demographicRelated' AS relationship, CAST(1 AS BIGINT) AS frequency,
              CASE WHEN target_type = 'email' THEN '2023-06-01' ELSE '2024-01-01' END AS created_date, '2024-01-01' AS last_seen_date, true AS active_flag FROM demo_edges""",
    DEMO_VIEWS,
)
def q_demo_edges(t: Tables) -> DataFrame:
    """Merged into a table that saw the e-mail edges half a year before."""
    maids, emails = demographic(t)
    earlier = ig.demographic_edges(maids, emails, "2023-06-01").filter(F.col("target_type") == codes.EMAIL)
    return ig.demographic_edges_merge(earlier, ig.demographic_edges(maids, emails, "2024-01-01"))


# ---- components and customers -------------------------------------------------------


def graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    edges = ig.identity_edges(ig.related_identities(chg.snapshot_as_diff(order_version(t, 1)), TODAY))
    lone = t.read("customer").select(F.lit(codes.MAID_AAID).alias("type"), F.concat(F.lit("dev"), "c_custkey").alias("identity_id"))
    return lone, edges


def components(t: Tables) -> DataFrame:
    return ig.identity_components(*graph(t))


def previous_customers(t: Tables) -> DataFrame:
    """Customers of an earlier run: four customer keys each, every ninth inactive."""
    k = F.col("c_custkey")
    groups = t.read("customer").groupBy(F.floor(k / 4).alias("n")).agg(F.array_sort(F.collect_set(t.email(k))).alias("emails"))
    return groups.select(
        F.concat(F.lit("old"), "n").alias("customer_360_id"),
        F.create_map(F.lit(codes.EMAIL), "emails").alias("identities"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("n") % 50).cast("int")).alias("create_date"),
        F.lit("2001-01-01").cast("date").alias("update_date"),
        (F.col("n") % 9 != 8).alias("active_flag"),
    )


COMPONENT_VIEWS = {
    **EDGE_VIEWS,
    "links": """SELECT DISTINCT source_type || ':' || source AS a, target_type || ':' || target AS b FROM base_edges""",
    "both_links": "SELECT a, b FROM links UNION SELECT b, a FROM links",
    "reach": """SELECT a AS id, a AS label FROM both_links UNION SELECT b.b, r.label FROM reach r JOIN both_links b ON b.a = r.id""",
    "comps": """SELECT id, min(label) AS component_id FROM reach GROUP BY id
                UNION ALL SELECT 'MAID-AAID:dev' || c_custkey, 'MAID-AAID:dev' || c_custkey FROM customer""",
    "prev": """SELECT 'old' || (c_custkey // 4) AS customer_360_id, 'email:c' || c_custkey || '@shop' || (c_custkey % 3) || '.com' AS id,
                      count(*) OVER (PARTITION BY c_custkey // 4) AS total,
                      DATE '2000-01-01' + CAST((c_custkey // 4) % 50 AS INTEGER) AS create_date, (c_custkey // 4) % 9 <> 8 AS active FROM customer""",
    "match": """SELECT component_id, customer_360_id, create_date, total FROM comps JOIN prev USING (id) WHERE active
                GROUP BY ALL HAVING 2 * count(*) > total""",
    "winner": """SELECT component_id, customer_360_id, create_date FROM (
                     SELECT *, row_number() OVER (PARTITION BY component_id ORDER BY create_date, total DESC, customer_360_id) AS rn FROM match) WHERE rn = 1""",
    "owner": "SELECT id AS component_id, max(customer_360_id) AS own FROM prev WHERE active GROUP BY id",
    "current_360": f"""
        SELECT coalesce(w.customer_360_id, sha256(c.component_id || '|' || coalesce(o.own, '') || '|{TODAY}')) AS customer_360_id,
               string_agg(c.id, '|' ORDER BY split_part(c.id, ':', 1), c.id) AS identities,
               strftime(coalesce(any_value(w.create_date), DATE '{TODAY}'), '%Y-%m-%d') AS create_date, '{TODAY}' AS update_date, true AS active_flag
        FROM comps c LEFT JOIN winner w USING (component_id) LEFT JOIN owner o USING (component_id)
        GROUP BY c.component_id, w.customer_360_id, o.own""",
    "lost_360": """
        SELECT customer_360_id, string_agg(id, '|' ORDER BY id) AS identities, strftime(any_value(create_date), '%Y-%m-%d') AS create_date,
               '2001-01-01' AS update_date, any_value(active) AS active_flag FROM prev GROUP BY customer_360_id""",
}


def flat(customers: DataFrame) -> DataFrame:
    entries = F.flatten(
        F.transform(
            F.array_sort(F.map_entries("identities")),
            lambda e: F.transform(e["value"], lambda v: qualified_identity(e["key"], v)),
        )
    )
    return customers.withColumn("identities", F.array_join(entries, "|"))


@query("connected_components", "SELECT id AS qualified_identity, component_id FROM comps", COMPONENT_VIEWS)
def q_components(t: Tables) -> DataFrame:
    return components(t)


UPDATED_VIEWS = {
    **COMPONENT_VIEWS,
    "merged_edges": """SELECT source_type || ':' || source AS a, target_type || ':' || target AS b
                FROM base_edges b FULL JOIN diff_edges d USING (source, source_type, target, target_type)
                WHERE b.source IS NULL OR d.source IS NULL OR b.f + d.f > 0""",
    "merged_links": "SELECT a, b FROM merged_edges UNION SELECT b, a FROM merged_edges",
    "merged_reach": """SELECT id, id AS label FROM (SELECT id FROM comps UNION SELECT a FROM merged_links)
                UNION SELECT l.b, r.label FROM merged_reach r JOIN merged_links l ON l.a = r.id""",
}


@query("connected_components_update", "SELECT id AS qualified_identity, min(label) AS component_id FROM merged_reach GROUP BY id", UPDATED_VIEWS)
def q_components_update(t: Tables) -> DataFrame:
    """The graph of the first version is stored with its labels; the edges that the next version adds and drops are merged in."""

    def links(edges: DataFrame) -> DataFrame:
        ends = [qualified_identity(F.col(f"{end}_type"), F.col(end)).alias(name) for end, name in (("source", "src"), ("target", "dst"))]
        return cu.plain_edges(edges.filter("active_flag").select(*ends))

    lone, before = graph(t)
    merged = cu.stored(links(ig.identity_edges_merge(before, ig.identity_edges(ig.related_identities(order_diff(t), TODAY)))), "merged")
    edges = cu.stored(links(before), "edges")
    labels = cu.stored(ig.identity_components(lone, before).withColumnRenamed("qualified_identity", "id"), "labels")
    inserted, deleted = without_matches(merged, edges, ["src", "dst"]), without_matches(edges, merged, ["src", "dst"])
    return cu.update_components(labels, edges, inserted, deleted).withColumnRenamed("id", "qualified_identity")


@query(
    "customer360_expand",
    "SELECT id AS qualified_identity, customer_360_id, CAST(total AS BIGINT) AS num_identities, strftime(create_date, '%Y-%m-%d') AS create_date FROM prev",
    COMPONENT_VIEWS,
)
def q_expand(t: Tables) -> DataFrame:
    return ig.customer360_expand(previous_customers(t))


def current_customers(t: Tables) -> DataFrame:
    return ig.customer360_update(components(t), previous_customers(t), TODAY)


@query("customer360_update", "SELECT * FROM current_360", COMPONENT_VIEWS)
def q_update(t: Tables) -> DataFrame:
    return flat(current_customers(t))


@query(
    "customer360_deactivate",
    """SELECT * FROM current_360 UNION ALL SELECT * REPLACE (false AS active_flag) FROM lost_360
       WHERE active_flag AND customer_360_id NOT IN (SELECT customer_360_id FROM current_360)""",
    COMPONENT_VIEWS,
)
def q_deactivate(t: Tables) -> DataFrame:
    return flat(ig.customer360_deactivate(previous_customers(t), current_customers(t)))


@query(
    "customer360_merge",
    """SELECT * FROM current_360 UNION ALL SELECT * REPLACE (false AS active_flag) FROM lost_360
       WHERE customer_360_id NOT IN (SELECT customer_360_id FROM current_360)""",
    COMPONENT_VIEWS,
)
def q_customer_merge(t: Tables) -> DataFrame:
    previous = previous_customers(t)
    reconciled = ig.customer360_deactivate(previous, current_customers(t))
    return flat(ig.customer360_merge(previous, reconciled))
