"""Oracle SQL for menu engineering (DOM-01 .. DOM-04)."""

from __future__ import annotations

from tavola_oracle.mart_sql import R, ctes
from tavola.operators.filters import NOISE_PATTERNS

MEASURES = ["quantity", "menu_price", "menu_cost", "margin", "cost_pct", "sales",
            "total_cost", "profit"]
NOISE = "|".join(f"(?:{p})" for p in NOISE_PATTERNS).replace("'", "''")


def _mix(fill_cost: bool) -> str:
    cost = "COALESCE(mc.cost, 0.0)" if fill_cost else "mc.cost"
    return f"""
        SELECT pm.location, pm.store_id, pm.concept, pm.menu_item, pm.qty AS quantity,
               pm.price AS menu_price, {cost} AS menu_cost, pm.sales,
               pm.cat1 AS category1, pm.cat2 AS category2, pm.cat3 AS category3
        FROM product_mix pm LEFT JOIN menu_cost mc
          ON mc.store_id = pm.store_id AND mc.itemid = pm.itemid"""


METRICS = """
        SELECT *, CASE WHEN COALESCE(menu_price, 0) <> 0 THEN menu_cost / menu_price ELSE 0.0 END AS cost_pct,
               menu_price - menu_cost AS margin, quantity * menu_cost AS total_cost,
               quantity * (menu_price - menu_cost) AS profit"""

SPECIALTY = """
        SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name FROM part WHERE p_brand = 'Brand#13'"""


def menu_engineering(date: str, year: int, period: int) -> str:
    cols = ", ".join(f"{R(c, 4)} AS {c}" for c in MEASURES)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in
                           ["location", "store_id", "concept", "menu_item", *MEASURES,
                            "category1", "category2", "category3"])
    return ctes("product_mix", "menu_cost", "restaurants", "item", extra={
        "mix": "SELECT * REPLACE (COALESCE(category1, 'None') AS category1, COALESCE(category2, 'None') AS category2, "
               "COALESCE(category3, 'None') AS category3) FROM (" + _mix(True) + ")",
        "params": "SELECT * FROM (VALUES (4, 0.19), (9, 0.19), (11, 0.84), (15, 0.96), (16, 0.69), "
                  "(17, 0.84)) AS p(store_id, default_cost)",
        "entrees": "SELECT store_id, sum(quantity) AS entrees FROM mix WHERE category2 = 'Entree' GROUP BY 1",
        "recipe": """SELECT mc.store_id, min(mc.cost) AS recipe_cost FROM menu_cost mc
                     JOIN item i ON i.itemid = mc.itemid
                     WHERE regexp_matches(i.name, '(?i)Bread.*Basket') GROUP BY 1""",
        "bb": """SELECT r.name AS location, r.id AS store_id, 'Steakhouse' AS concept,
                        'Bread Basket per Entree' AS menu_item, COALESCE(e.entrees, 0.0) AS quantity,
                        0.0 AS menu_price, COALESCE(rc.recipe_cost, p.default_cost) AS menu_cost,
                        0.0 AS sales, 'Food' AS category1, 'No Charge' AS category2, 'None' AS category3
                 FROM params p JOIN restaurants r ON r.id = p.store_id
                 LEFT JOIN entrees e ON e.store_id = p.store_id
                 LEFT JOIN recipe rc ON rc.store_id = p.store_id""",
        "allrows": "SELECT * FROM mix UNION ALL BY NAME SELECT * FROM bb",
        "m": METRICS + " FROM allrows",
    }) + f"""
    SELECT location, store_id, '{date}' AS date, {year} AS year, {period} AS period, concept,
           menu_item, {cols}, category1, category2, category3
    FROM m WHERE {notnull}"""


def _rated() -> str:
    return ctes("product_mix", "menu_cost", "restaurants", extra={
        "mix": _mix(False),
        "specialty": SPECIALTY,
        "kept": f"""SELECT * FROM mix WHERE menu_item NOT IN (SELECT name FROM specialty)
                    AND NOT COALESCE(regexp_matches(menu_item, '{NOISE}'), false)""",
        "stripped": r"""SELECT * REPLACE (regexp_replace(regexp_replace(menu_item,
                           '^(Add|Extra|Lite|On Side)\s+', ''), '\s+(On Side|Only)$', '') AS menu_item)
                        FROM kept""",
        "m": METRICS + " FROM (SELECT * REPLACE (COALESCE(category2, 'None') AS category2) FROM stripped)",
        "means": "SELECT location, category2, avg(quantity) AS mq, avg(margin) AS mm FROM m GROUP BY 1, 2",
        "flags": """SELECT m.*, NOT COALESCE(m.quantity < g.mq, false) AS qh,
                           NOT COALESCE(m.margin < g.mm, false) AS mh
                    FROM m JOIN means g ON g.location = m.location AND g.category2 = m.category2""",
        "rated": f"""SELECT location, category2, menu_item, {', '.join(f'{R(c, 4)} AS {c}' for c in MEASURES)},
                        category1,
                        CASE WHEN qh AND mh THEN 'Star' WHEN qh AND NOT mh THEN 'Opportunity'
                             WHEN NOT qh AND mh THEN 'Puzzle' ELSE 'Dog' END AS rating
                     FROM flags""",
    })


def menu_rating() -> str:
    return _rated() + "SELECT * FROM rated"


def menu_rating_totals() -> str:
    return _rated() + f"""
    SELECT *, 'item' AS row_type FROM rated
    UNION ALL BY NAME
    SELECT location, category2, {R('quantity', 4)} AS quantity, {R('sales', 4)} AS sales,
           {R('total_cost', 4)} AS total_cost, {R('profit', 4)} AS profit,
           {R('CASE WHEN COALESCE(sales, 0) <> 0 THEN total_cost / sales ELSE 1.0 END', 4)} AS cost_pct,
           'Total' AS row_type
    FROM (SELECT location, category2, COALESCE(sum(quantity), 0) AS quantity,
                 COALESCE(sum(sales), 0) AS sales, COALESCE(sum(total_cost), 0) AS total_cost,
                 COALESCE(sum(profit), 0) AS profit
          FROM rated GROUP BY 1, 2)"""


def menu_report(first: str = "profit", second: str = "quantity") -> str:
    order = f"""location, category2, row_type = 'Total', {first} DESC NULLS LAST, {second} DESC NULLS LAST,
                menu_item NULLS LAST, menu_price NULLS LAST, menu_cost NULLS LAST, sales NULLS LAST"""
    with_, rows = menu_rating_totals().split("SELECT *, 'item' AS row_type", 1)
    return with_ + f"SELECT *, row_number() OVER (ORDER BY {order}) AS line FROM (SELECT *, 'item' AS row_type" + rows + ") q"


def uncategorised_top25(by: str = "sales") -> str:
    sums = ", ".join(f"{R(f'COALESCE(sum({c}), 0.0)', 4)} AS {c}" for c in MEASURES)
    return ctes("product_mix", "menu_cost", "restaurants", extra={
        "mix": _mix(False),
        "specialty": SPECIALTY,
        "kept": f"""SELECT * FROM mix WHERE menu_item NOT IN (SELECT name FROM specialty)
                    AND NOT COALESCE(regexp_matches(menu_item, '{NOISE}'), false)""",
        "m": METRICS + " FROM kept WHERE category2 IS NULL",
        "s": f"SELECT menu_item, {', '.join(f'COALESCE(sum({c}), 0.0) AS {c}' for c in MEASURES)} "
             "FROM m GROUP BY menu_item",
    }) + f"""
    SELECT menu_item, {', '.join(f'{R(c, 4)} AS {c}' for c in MEASURES)}
    FROM s ORDER BY {by} DESC, menu_item LIMIT 25"""
