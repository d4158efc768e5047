"""The same views in SQL, for the oracle side."""

from __future__ import annotations

import re

VIEWS = {
    "retail_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ord_id,
               o_orderdate + to_minutes(CAST((o_orderkey % 24) * 60 + o_orderkey % 60 AS INTEGER)) AS ord_timestamp,
               CAST(o_orderdate AS DATE) AS ord_date,
               'p' || (o_orderkey % 5) AS partner_id, 'loc' || (o_orderkey % 25) AS location_id,
               CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 1 ELSE 2 END AS ord_state_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS ord_pay_total,
               CAST(o_orderkey % 7 AS INTEGER) AS ord_originate_channel_id,
               CAST((o_orderkey // 7) % 7 AS INTEGER) AS ord_target_channel_id,
               o_custkey, o_orderkey
        FROM orders""",
    "order_lines": """
        SELECT r.*, CAST(l_partkey AS VARCHAR) AS item_id, CAST(l_quantity AS DECIMAL(12,2)) AS item_quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS item_total
        FROM lineitem JOIN retail_orders r ON r.o_orderkey = l_orderkey""",
    "order_tenders": """
        SELECT ord_id, 't' || o_orderkey AS tender_id FROM retail_orders
        UNION ALL SELECT ord_id, 't' || (o_orderkey // 2) FROM retail_orders WHERE o_orderkey % 3 = 0""",
    "order_identities": """
        SELECT ord_id, 'email' AS identity_type, 'c' || o_custkey || '@shop' || (o_custkey % 3) || '.com' AS identity_id FROM retail_orders
        UNION ALL SELECT ord_id, 'phone', '1212' || (o_custkey // 3 + 2000000) FROM retail_orders
        UNION ALL SELECT ord_id, 'combination-card', 'card' || ((o_custkey + 1) // 3) FROM retail_orders WHERE o_custkey % 12 IN (2, 3)""",
    "locations": """
        SELECT 'p' || (n_nationkey % 5) AS partner_id, 'loc' || n_nationkey AS location_id, 'Store ' || n_name AS location_nm,
               n_nationkey % 7 AS location_type, r_name AS region, lower(n_name) AS state_code,
               'city ' || lower(n_name) AS city,
               (['America/New_York', 'America/Chicago', 'America/Denver', 'America/Los_Angeles'])[n_nationkey % 4 + 1] AS timezone,
               30.0::DOUBLE + n_nationkey * 0.5::DOUBLE AS lat, -120.0::DOUBLE + n_nationkey * 1.5::DOUBLE AS long,
               CASE WHEN n_nationkey % 9 = 8 THEN '0' ELSE '1' END AS active_flg
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "items": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, 'p' || i AS partner_id,
               CASE p_partkey % 13 WHEN 0 THEN 'Extra ' || p_name WHEN 1 THEN '12 oz' WHEN 2 THEN 'Small' ELSE p_name END AS item_nm,
               CASE p_size % 3 WHEN 0 THEN 'Food' WHEN 1 THEN 'Normal' ELSE 'Variation' END AS item_type, p_type AS category
        FROM part, (SELECT unnest([0, 1, 2, 3, 4]) AS i)""",
    "food_items": r"""
        SELECT DISTINCT item_id, partner_id, item_nm FROM items
        WHERE regexp_matches(item_type, '[Ff][Oo][Oo][Dd]|Normal') AND item_nm IS NOT NULL
          AND item_nm NOT IN ('Small', 'Large', 'Medium', 'Spicy', 'Plain', 'null', '')
          AND NOT regexp_matches(item_nm, '^([Aa][Dd][Dd]|[Nn][Oo][Tt]?|[Ss][Ii][Dd][Ee]|[Ss][Uu][Bb]|[Ee][Xx][Tt][Rr][Aa]|[Ll][Ii][Gg][Hh][Tt]) |^[0-9]+ [Oo][Zz]$')""",
    "tenders": """
        SELECT 't' || o_orderkey AS tender_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 3
                                    WHEN '4-NOT SPECIFIED' THEN 4 ELSE 99 END AS tender_type
        FROM orders""",
    "customers": """
        SELECT DISTINCT 'cust' || (c_custkey // 30) AS customer_360_id, c_custkey // 30 AS n,
               DATE '2000-01-01' + CAST((c_custkey // 30) % 365 AS INTEGER) AS create_date,
               (c_custkey // 30) % 10 <> 9 AS active_flag
        FROM customer""",
    "customer_identities": """
        SELECT DISTINCT 'cust' || (c_custkey // 30) AS customer_360_id, 'email' AS identity_type,
               'c' || c_custkey || '@shop' || (c_custkey % 3) || '.com' AS identity_id FROM customer
        UNION ALL
        SELECT DISTINCT 'cust' || (c_custkey // 30), 'phone', '1212' || (c_custkey // 3 + 2000000) FROM customer""",
    "active_identities": """
        SELECT i.* FROM customer_identities i JOIN customers c USING (customer_360_id) WHERE active_flag""",
    "order_customers": """
        SELECT DISTINCT o.ord_id, a.customer_360_id FROM order_identities o JOIN active_identities a USING (identity_type, identity_id)""",
    "customer_orders": """
        SELECT customer_360_id, partner_id, location_id, ord_id, ord_date, ord_pay_total
        FROM retail_orders JOIN order_customers USING (ord_id)""",
    "device_pings": """
        SELECT CAST(floor(epoch(ts)) AS BIGINT) - 8500 * 86400 AS utc_seconds,
               30.0::DOUBLE + ((user_id * 7 + event_id) % 25) * 0.5::DOUBLE + ((event_id % 41) - 20) * 0.0005::DOUBLE AS latitude,
               -120.0::DOUBLE + ((user_id * 7 + event_id) % 25) * 1.5::DOUBLE + ((event_id % 37) - 18) * 0.0005::DOUBLE AS longitude,
               CAST(event_id % 60 AS DOUBLE) AS horizontal_accuracy,
               CASE WHEN user_id % 2 = 0 THEN 'MAID-AAID' ELSE 'MAID-IDFA' END AS maid_type, 'dev' || user_id AS maid
        FROM events""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the body with the views it names, and the views those name, in order."""
    views = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.append(name)
                at = needed.index(name)
                before = len(needed)
                visit(views[name])
                # dependencies found below must come first
                found = needed[before:]
                del needed[before:]
                needed[at:at] = found

    visit(body)
    if not needed:
        return body
    recursive = "RECURSIVE " if "reach" in needed else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({views[n]})" for n in needed) + "\n" + body


def first_row(source: str, keys: str, order: str, columns: str = "*") -> str:
    """One row per key, the smallest by order with nulls first."""
    ordered = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) AS rn_ "
        f"FROM ({source})) WHERE rn_ = 1"
    )
