"""Queries of the market, item and category insights, and of the offset bookkeeping they use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import insights as ins

from tillwork.operators.keyed import merge_upsert
from tillwork.plans.bindings import Tables
from tillwork.plans.registry import query

COMPLETED_SQL = """
    SELECT o.partner_id,
           CASE l.location_type WHEN 1 THEN 'Restaurant' WHEN 2 THEN 'C-Store' WHEN 3 THEN 'Hotel' WHEN 4 THEN 'Bar'
                WHEN 5 THEN 'Website' WHEN 6 THEN 'Mobile' WHEN 99 THEN 'Other' ELSE 'Unknown' END AS location_type,
           l.region, upper(l.state_code) AS state,
           'City ' || upper(l.state_code[1]) || lower(l.state_code[2:]) AS city,
           o.location_id, l.location_nm, o.ord_date, o.ord_pay_total, o.ord_id
    FROM {orders} o JOIN locations l ON o.partner_id = l.partner_id AND o.location_id = l.location_id
    WHERE o.ord_state_id = 4"""
PARTNER_SQL = """
    SELECT partner_id, location_type, region, state, city, location_id, ord_date AS date, min(location_nm) AS location_nm,
           sum(ord_pay_total) AS transaction_amount, count(ord_id) AS transaction_quantity
    FROM (SELECT DISTINCT * FROM completed) GROUP BY ALL"""
INSIGHT_VIEWS = {
    "completed": COMPLETED_SQL.format(orders="retail_orders"),
    "completed_lines": COMPLETED_SQL.format(orders="order_lines"),
    "partner_market": PARTNER_SQL,
}
TAXONOMY_MODULUS = 7


def completed(t: Tables) -> DataFrame:
    return ins.completed_orders_by_location(t.order_lines(), t.locations())


def partner_market(t: Tables) -> DataFrame:
    return ins.partner_market_insights(completed(t))


@query(
    "completed_orders_by_location",
    "SELECT *  EXCLUDE (ord_date, ord_pay_total), strftime(ord_date, '%Y-%m-%d') AS ord_date, "
    "CAST(ord_pay_total AS DOUBLE) AS ord_pay_total FROM completed_lines",
    INSIGHT_VIEWS,
)
def q_completed(t: Tables) -> DataFrame:
    return completed(t)


@query(
    "partner_market_insights",
    "SELECT * EXCLUDE (date, transaction_amount), strftime(date, '%Y-%m-%d') AS date, "
    "CAST(transaction_amount AS DOUBLE) AS transaction_amount FROM partner_market "
    "WHERE EXISTS (SELECT 1 FROM completed_lines c WHERE c.location_id = partner_market.location_id AND c.ord_date = partner_market.date)",
    {
        **INSIGHT_VIEWS,
        "completed": "SELECT * FROM (" + COMPLETED_SQL.format(orders="retail_orders")
        + ") WHERE ord_id IN (SELECT ord_id FROM order_lines)",
    },
)
def q_partner_market(t: Tables) -> DataFrame:
    return partner_market(t)


TOTAL_VIEWS = {
    **INSIGHT_VIEWS,
    "completed": "SELECT * FROM (" + COMPLETED_SQL.format(orders="retail_orders")
    + ") WHERE ord_id IN (SELECT ord_id FROM order_lines)",
}


@query(
    "total_market_insights",
    "SELECT location_type, region, state, city, strftime(date, '%Y-%m-%d') AS date, "
    "CAST(sum(transaction_amount) AS DOUBLE) AS transaction_amount, CAST(sum(transaction_quantity) AS BIGINT) AS transaction_quantity "
    "FROM partner_market GROUP BY ALL",
    TOTAL_VIEWS,
)
def q_total_market(t: Tables) -> DataFrame:
    return ins.total_market_insights(partner_market(t))


# ---- items --------------------------------------------------------------------------


@query("food_item_filter", "SELECT item_id, partner_id, item_nm FROM food_items")
def q_food(t: Tables) -> DataFrame:
    return ins.food_items(t.items()).select("item_id", "partner_id", "item_nm").distinct()


ITEM_VIEWS = {
    "sold": """
        SELECT DISTINCT ON (l.ord_id, l.partner_id, l.location_id, f.item_nm)
               l.ord_id, l.ord_date, l.partner_id, l.location_id, f.item_nm, l.item_quantity, l.item_total
        FROM order_lines l JOIN food_items f ON f.partner_id = l.partner_id AND f.item_id = l.item_id
        WHERE l.ord_state_id = 4 ORDER BY l.item_quantity, l.item_total""",
    "buyer": "SELECT ord_id, min(customer_360_id) AS customer_360_id FROM order_customers GROUP BY ord_id",
    "sales": """
        SELECT s.*, p.region, p.state_code, p.city, p.location_nm, b.customer_360_id
        FROM sold s LEFT JOIN locations p ON p.partner_id = s.partner_id AND p.location_id = s.location_id
                    LEFT JOIN buyer b ON b.ord_id = s.ord_id""",
    "item_insights": """
        SELECT ord_date, partner_id, region, state_code, city, location_id, location_nm, item_nm AS pos_item_nm,
               count(DISTINCT ord_id) AS transaction_quantity, sum(item_quantity) AS item_quantity,
               sum(item_total) AS item_total,
               coalesce(array_to_string(list_sort(list(DISTINCT customer_360_id) FILTER (customer_360_id IS NOT NULL)), '|'), '') AS customer_360_ids
        FROM sales GROUP BY ALL""",
    "universe": """
        SELECT partner_id, item_nm AS pos_item_nm, category AS item_category,
               CASE WHEN length(item_nm) % 3 = 0 THEN 'Edited ' || category END AS item_category_modified,
               CASE WHEN length(item_nm) % 4 = 0 THEN upper(item_nm) END AS item_nm_modified
        FROM (SELECT DISTINCT partner_id, item_nm, category FROM items)""",
}


def item_sales(t: Tables) -> DataFrame:
    return ins.item_sales_enrich(t.order_lines(), t.locations(), t.items(), t.customer_360())


def item_universe(t: Tables) -> DataFrame:
    base = t.items().select("partner_id", F.col("item_nm").alias("pos_item_nm"), F.col("category").alias("item_category")).distinct()
    length = F.length("pos_item_nm")
    return base.select(
        "*",
        F.when(length % 3 == 0, F.concat(F.lit("Edited "), "item_category")).alias("item_category_modified"),
        F.when(length % 4 == 0, F.upper("pos_item_nm")).alias("item_nm_modified"),
    )


@query(
    "item_sales_enrich",
    "SELECT * EXCLUDE (ord_date, item_quantity, item_total), strftime(ord_date, '%Y-%m-%d') AS ord_date, "
    "CAST(item_quantity AS DOUBLE) AS item_quantity, CAST(item_total AS DOUBLE) AS item_total FROM sales",
    ITEM_VIEWS,
)
def q_item_sales(t: Tables) -> DataFrame:
    return item_sales(t)


@query(
    "partner_item_insights",
    "SELECT * EXCLUDE (ord_date, item_quantity, item_total), strftime(ord_date, '%Y-%m-%d') AS ord_date, "
    "CAST(item_quantity AS DOUBLE) AS item_quantity, CAST(item_total AS DOUBLE) AS item_total FROM item_insights",
    ITEM_VIEWS,
)
def q_item_insights(t: Tables) -> DataFrame:
    return ins.partner_item_insights(item_sales(t))


def taxonomy(t: Tables) -> DataFrame:
    """Reference names: every part name with its types, spelled as another vendor would."""
    name = F.concat_ws("-", F.upper("p_brand"), F.initcap("p_name"))
    plural = F.concat(F.col("p_name"), F.lit("s"))
    named = t.read("part").select(F.when(F.col("p_partkey") % TAXONOMY_MODULUS == 0, name).otherwise(plural).alias("item_nm"), "p_type")
    return named.groupBy("item_nm").agg(F.array_sort(F.collect_set("p_type")).alias("item_categories"))


TOKENS_SQL = "list_sort(list_distinct(list_filter(string_split(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')))"
# the longest common subsequence of a and b by bit operations: bit i of a letter's mask is a's place i
LCS_SQL = """length(a) - bit_count(list_reduce(
    list_prepend((1::HUGEINT << length(a)) - 1, list_transform(string_split(b, ''),
        lambda c: list_sum(list_transform(range(length(a)), lambda i: CASE WHEN a[i + 1] = c THEN 1::HUGEINT << i ELSE 0::HUGEINT END)))),
    lambda r, m: ((r + (r & m)) | (r - (r & m))) & ((1::HUGEINT << length(a)) - 1)))"""
MATCH_VIEWS = {
    "taxonomy": f"""SELECT CASE WHEN p_partkey % {TAXONOMY_MODULUS} = 0 THEN upper(p_brand) || '-' || array_to_string(list_transform(string_split(p_name, ' '),
                           lambda w: upper(w[1]) || lower(w[2:])), ' ') ELSE p_name || 's' END AS right_name, p_type FROM part""",
    "left_names": f"SELECT DISTINCT item_nm AS left_name, {TOKENS_SQL.format('item_nm')} AS l FROM food_items",
    "right_names": f"SELECT DISTINCT right_name, {TOKENS_SQL.format('right_name')} AS r FROM taxonomy",
    "name_pairs": """SELECT left_name, right_name, array_to_string(common, ' ') AS base, array_to_string(common || list_filter(l, lambda t: NOT list_contains(r, t)), ' ') AS a,
                            array_to_string(common || list_filter(r, lambda t: NOT list_contains(l, t)), ' ') AS b
                     FROM (SELECT *, list_filter(l, lambda t: list_contains(r, t)) AS common FROM left_names, right_names WHERE len(l) > 0 AND len(r) > 0)""",
    "scored_pairs": f"""SELECT left_name, right_name, greatest(
                            CASE WHEN base = '' THEN 0 ELSE floor(200.0::DOUBLE * length(base) / (length(base) + length(a)) + 0.5) END,
                            CASE WHEN base = '' THEN 0 ELSE floor(200.0::DOUBLE * length(base) / (length(base) + length(b)) + 0.5) END,
                            CASE WHEN 200.0 * least(length(a), length(b)) / (length(a) + length(b)) < 82 THEN 0
                                 ELSE floor(200.0::DOUBLE * ({LCS_SQL}) / (length(a) + length(b)) + 0.5) END) AS score FROM name_pairs""",
}


@query(
    "item_category_match",
    """SELECT DISTINCT partner_id, coalesce(p_type, 'Unknown') AS item_category, item_nm AS pos_item_nm
       FROM (SELECT DISTINCT partner_id, item_nm FROM food_items) LEFT JOIN (
            SELECT left_name, p_type FROM scored_pairs JOIN taxonomy USING (right_name) WHERE score > 82) m ON m.left_name = item_nm""",
    MATCH_VIEWS,
)
def q_item_category(t: Tables) -> DataFrame:
    return ins.item_category_match(t.items(), taxonomy(t))


@query(
    "item_universe_merge",
    """SELECT partner_id, item_category, pos_item_nm, item_category_modified, item_nm_modified,
              CASE WHEN old THEN length(pos_item_nm) % 3 = 0 ELSE false END AS is_category_modified,
              CASE WHEN old THEN length(pos_item_nm) % 4 = 0 ELSE false END AS is_item_modified,
              CASE WHEN new THEN 'run2' ELSE 'run1' END AS updated_on
       FROM (SELECT u.partner_id, u.item_category, u.pos_item_nm,
                    length(u.pos_item_nm) % 2 = 0 AS old, length(u.item_category) % 2 = 0 AS new,
                    CASE WHEN length(u.pos_item_nm) % 2 = 0 THEN u.item_category_modified END AS item_category_modified,
                    CASE WHEN length(u.pos_item_nm) % 2 = 0 THEN u.item_nm_modified END AS item_nm_modified
             FROM universe u) WHERE old OR new""",
    ITEM_VIEWS,
)
def q_item_universe(t: Tables) -> DataFrame:
    length = F.length("pos_item_nm")
    universe = item_universe(t)
    old = universe.filter(length % 2 == 0).select(
        "*",
        (length % 3 == 0).alias("is_category_modified"),
        (length % 4 == 0).alias("is_item_modified"),
        F.lit("run1").alias("updated_on"),
    )
    fresh = universe.filter(F.length("item_category") % 2 == 0).select(
        "partner_id", "item_category", "pos_item_nm", F.lit("run2").alias("updated_on")
    )
    return ins.item_universe_merge(old, fresh)


CATEGORY_VIEWS = {
    **ITEM_VIEWS,
    "category_source": """
        SELECT i.ord_date, i.partner_id, i.region, i.state_code, i.city, i.location_id, i.location_nm,
               i.transaction_quantity, i.item_quantity, i.item_total,
               coalesce(u.item_category_modified, u.item_category) AS item_category,
               coalesce(u.item_nm_modified, u.pos_item_nm) AS item_nm
        FROM item_insights i JOIN universe u ON u.partner_id = i.partner_id AND u.pos_item_nm = i.pos_item_nm""",
}


def category_source(t: Tables) -> DataFrame:
    insights = ins.partner_item_insights(item_sales(t))
    return ins.category_insights_source(insights, item_universe(t))


@query(
    "category_insights_source",
    "SELECT * EXCLUDE (ord_date, item_quantity, item_total), strftime(ord_date, '%Y-%m-%d') AS ord_date, "
    "CAST(item_quantity AS DOUBLE) AS item_quantity, CAST(item_total AS DOUBLE) AS item_total FROM category_source",
    CATEGORY_VIEWS,
)
def q_category_source(t: Tables) -> DataFrame:
    return category_source(t)


@query(
    "partner_category_insights",
    "SELECT strftime(ord_date, '%Y-%m-%d') AS ord_date, partner_id, region, state_code, city, location_id, location_nm, item_category, "
    "CAST(sum(transaction_quantity) AS BIGINT) AS transaction_quantity, CAST(sum(item_quantity) AS DOUBLE) AS item_quantity, "
    "CAST(sum(item_total) AS DOUBLE) AS item_total FROM category_source GROUP BY ALL",
    CATEGORY_VIEWS,
)
def q_category_insights(t: Tables) -> DataFrame:
    return ins.partner_category_insights(category_source(t))


@query(
    "insight_upsert",
    """SELECT strftime(date, '%Y-%m-%d') AS date, partner_id, location_id,
              CAST(CASE WHEN year(date) % 2 = 1 THEN transaction_amount ELSE 0 END AS DOUBLE) AS transaction_amount
       FROM partner_market WHERE year(date) % 2 = 1 OR month(date) <= 6""",
    TOTAL_VIEWS,
)
def q_insight_upsert(t: Tables) -> DataFrame:
    """A published table of half-years, then the odd years recomputed."""
    current = partner_market(t).select("date", "partner_id", "location_id", "transaction_amount")
    published = current.filter(F.month("date") <= 6).withColumn("transaction_amount", F.lit(0).cast("decimal(22,2)"))
    fresh = current.filter(F.year("date") % 2 == 1)
    return merge_upsert(published, fresh, ["date", "partner_id", "location_id"])
