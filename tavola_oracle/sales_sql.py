"""Oracle SQL for theoretical usage (VW-06, VW-07), over the raw tables."""

from __future__ import annotations

from tavola_oracle.mart_sql import R, ctes

COMPONENTS = """
    SELECT p.p_partkey AS rid, p.p_type AS kind, p.p_name || ' ' || p.p_partkey AS rname, c.p_partkey AS cid,
           CASE WHEN exists (SELECT 1 FROM part x WHERE x.p_partkey IN (2 * c.p_partkey + 1, 2 * c.p_partkey + 2, 3 * c.p_partkey + 5))
                THEN 'PREP ' ELSE '' END || c.p_name || ' ' || c.p_partkey AS ingredient,
           [0.25, 0.5, 0.75, 1.0][c.p_partkey % 4 + 1] AS qty,
           ['Each', 'OZ-wt', 'OZ-fl', 'OZ-wt'][c.p_partkey % 4 + 1] AS base_uofm,
           CASE WHEN p.p_partkey % 2 = 0 THEN 'Casual' ELSE 'Steakhouse' END AS concept
    FROM part p JOIN part c ON c.p_partkey IN (2 * p.p_partkey + 1, 2 * p.p_partkey + 2, 3 * p.p_partkey + 5)"""


def _usage(as_of: str, condition: str, concept: str) -> str:
    return ctes("inv_items", "item_conversion", extra={
        "comp": COMPONENTS,
        "used": """SELECT rname AS menu_item, concept, ingredient, qty, base_uofm, rid FROM comp WHERE kind = 'PROMO'
                   UNION ALL SELECT 'PREP ' || rname, concept, ingredient, qty, base_uofm, rid FROM comp""",
        "swap": """SELECT DISTINCT a.ingredient AS prep, b.ingredient AS actual FROM comp a JOIN comp b ON b.rid = a.rid
                   WHERE starts_with(a.ingredient, 'PREP')""",
        "sold": f"""SELECT CAST(o_orderdate AS DATE) AS date, l_suppkey AS store_id, l_partkey, sum(l_quantity) AS sales_count
                    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                    WHERE CAST(o_orderdate AS DATE) >= DATE '{as_of}' - INTERVAL 1 MONTH {condition} GROUP BY ALL""",
        "final": f"""SELECT DISTINCT s.date, s.store_id, r.name AS store, u.menu_item AS menuitem, s.sales_count,
                           coalesce(w.actual, u.ingredient) AS ingredient, u.concept, u.qty, u.base_uofm, ic.weight_qty
                    FROM sold s JOIN restaurants r ON r.id = s.store_id JOIN part p ON p.p_partkey = s.l_partkey
                    JOIN used u ON u.menu_item = p.p_name || ' ' || p.p_partkey {concept}
                    LEFT JOIN swap w ON w.prep = u.ingredient
                    JOIN item_conversion ic ON ic.name = coalesce(w.actual, u.ingredient)
                    WHERE p.p_type = 'PROMO' AND ic.name IN (SELECT item_name FROM inv_items)""",
    }) + f"""
    SELECT CAST(f.date AS VARCHAR) AS date, c.dow, c.week, c.period, c.year, store_id, store, menuitem, sales_count, ingredient, concept,
           {R('qty * sales_count', 4)} AS base_usage, base_uofm,
           {R("CASE WHEN weight_qty > 0 AND base_uofm IN ('OZ-wt', 'OZ-fl', 'Each') THEN qty * sales_count / weight_qty ELSE 1 END", 4)}
             AS count_usage
    FROM final f JOIN calendar c ON c.date = f.date"""


def stockcount_sales(as_of: str) -> str:
    return _usage(as_of, "", "AND u.concept = r.concept")


def stockcount_sales_single_concept(as_of: str) -> str:
    return _usage(as_of, "AND o_orderstatus = 'F'",
                  "AND u.concept = (SELECT min(x.concept) FROM used x WHERE x.menu_item = u.menu_item)")
