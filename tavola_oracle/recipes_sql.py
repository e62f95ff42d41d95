"""Oracle SQL for the recipe jobs: paths enumerated by a recursive CTE."""

from __future__ import annotations

from tavola_oracle.mart_sql import R, ctes

GRAPH = {
    "raw_edges": """
        SELECT parent, child, CASE child % 4 WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 0.75 WHEN 3 THEN 0.0625 END::DOUBLE AS qty,
               CASE child % 4 WHEN 0 THEN 'Each' WHEN 1 THEN 'OZ-wt' WHEN 2 THEN 'OZ-fl'
                              WHEN 3 THEN 'LB' END AS uofm
        FROM (SELECT k.p_partkey AS parent, c.p_partkey AS child
              FROM part k JOIN part c ON c.p_partkey = 2 * k.p_partkey + 1
              UNION ALL
              SELECT k.p_partkey, c.p_partkey FROM part k JOIN part c ON c.p_partkey = 2 * k.p_partkey + 2
              UNION ALL
              SELECT k.p_partkey, c.p_partkey FROM part k JOIN part c ON c.p_partkey = 3 * k.p_partkey + 5)""",
    "edges": """
        SELECT e.parent, e.child, e.qty * u.base_qty AS qty, u.base_uofm AS uofm
        FROM raw_edges e LEFT JOIN units u ON u.name = e.uofm""",
    "yields": "SELECT DISTINCT parent AS recipe, CAST(parent % 3 + 1 AS DOUBLE) AS yield FROM edges",
    "roots": "SELECT p_partkey AS root, p_partkey AS recipe FROM part WHERE p_type = 'PROMO'",
}

WALK = {
    "walk(root, node, qty, uofm, depth)": """
        SELECT root, recipe, CAST(1.0 AS DOUBLE), CAST(NULL AS VARCHAR), 0 FROM roots
        UNION ALL
        SELECT w.root, e.child, w.qty * e.qty / COALESCE(y.yield, 1.0), e.uofm, w.depth + 1
        FROM walk w JOIN edges e ON e.parent = w.node LEFT JOIN yields y ON y.recipe = w.node""",
    "flat": f"""
        SELECT root AS menu_item_id, node AS item_id, i.name AS ingredient, walk.uofm,
               {R('sum(walk.qty)', 9)} AS qty, max(depth) AS depth
        FROM walk JOIN item i ON i.itemid = walk.node
        WHERE depth > 0 AND node NOT IN (SELECT parent FROM edges)
        GROUP BY root, node, i.name, walk.uofm""",
}


def recipe_explosion() -> str:
    return ctes("units", "item", extra={**GRAPH, **WALK}, recursive=True) + "SELECT * FROM flat"


def menu_item_recipes() -> str:
    return ctes("units", extra=GRAPH) + """
    SELECT root AS menu_item_id, recipe AS recipe_id FROM roots
    WHERE recipe IN (SELECT parent FROM edges)"""


def recipe_base_units() -> str:
    return ctes("units", "item", extra=GRAPH) + f"""
    SELECT CASE WHEN r.root % 2 = 0 THEN 'Casual' ELSE 'Steakhouse' END AS concept,
           rn.name AS menu_item, 'PREP ' || rn.name AS recipe,
           CASE WHEN e.child IN (SELECT parent FROM edges) THEN 'PREP ' || ci.name ELSE ci.name END
             AS ingredient,
           {R('e.qty', 6)} AS qty, e.uofm
    FROM edges e JOIN roots r ON r.recipe = e.parent
    JOIN item rn ON rn.itemid = r.root JOIN item ci ON ci.itemid = e.child"""


PAIRS = [("OZ-fl", "OZ-wt", "volume_qty", "weight_qty"), ("OZ-wt", "OZ-fl", "weight_qty", "volume_qty"),
         ("Each", "OZ-wt", "each_qty", "weight_qty"), ("Each", "OZ-fl", "each_qty", "volume_qty"),
         ("OZ-wt", "Each", "weight_qty", "each_qty"), ("OZ-fl", "Each", "volume_qty", "each_qty")]


def menu_cost_converted() -> str:
    from tavola_oracle.cost_sql import NEWEST_DESC
    factor = "CASE WHEN f.uofm = p.base_uofm THEN 1.0 " + " ".join(
        f"WHEN f.uofm = '{a}' AND p.base_uofm = '{b}' THEN c.{n} / NULLIF(c.{d}, 0)"
        for a, b, n, d in PAIRS) + " ELSE 1.0 END"
    known = "COALESCE(f.uofm = p.base_uofm " + " ".join(
        f"OR (f.uofm = '{a}' AND p.base_uofm = '{b}')" for a, b, _, _ in PAIRS) + ", false)"
    return ctes("units", "item", "purchases", "item_conversion", extra={
        **GRAPH, **WALK,
        "lp": f"SELECT *, row_number() OVER (PARTITION BY id, item ORDER BY {NEWEST_DESC}) AS rn FROM purchases",
        "quoted": f"""SELECT itemid AS item_id, id, base_uofm,
                             {R('amount / quantity / NULLIF(base_qty, 0)', 4)} AS base_cost
                      FROM lp WHERE rn = 1 AND quantity <> 0 AND base_uofm IS NOT NULL""",
        "price": """SELECT DISTINCT ON (item_id) item_id, base_cost, base_uofm
                    FROM quoted ORDER BY item_id, base_cost ASC NULLS LAST, base_uofm, id""",
    }, recursive=True) + f"""
    SELECT f.menu_item_id, f.item_id, f.uofm, p.base_uofm, f.qty, {R(factor, 6)} AS factor,
           {known} AS known_pair, {R(f'f.qty * ({factor}) * p.base_cost', 4)} AS cost
    FROM flat f JOIN price p ON p.item_id = f.item_id
    JOIN item_conversion c ON c.itemid = f.item_id"""
