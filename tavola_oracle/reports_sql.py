"""Oracle SQL for the reports and dimension jobs, from the raw tables."""

from __future__ import annotations

from tavola_oracle.mart_sql import R, ctes

RECIPE = "p_partkey IN (SELECT k.p_partkey FROM part k JOIN part c ON c.p_partkey IN (2 * k.p_partkey + 1, 2 * k.p_partkey + 2, 3 * k.p_partkey + 5))"


def receiving(by: str) -> str:
    col = {"VendorName": "vendor", "LocationName": "store"}[by]
    return ctes("purchases", extra={
        "lines": """SELECT p.*, n.n_name AS vendor FROM purchases p
                    JOIN supplier ON s_suppkey = p.id JOIN nation n ON n.n_nationkey = s_nationkey
                    WHERE p.discount < 0.1""",
        "head": """SELECT item, uofm AS unit, base_qty AS factor, base_uofm FROM lines
                   QUALIFY row_number() OVER (PARTITION BY item ORDER BY date, transactionid, lineid, amount, quantity, store) = 1""",
        "spend": f"""SELECT l.item AS ItemName, l.{col} AS {by}, h.unit,
                            coalesce(sum(CAST(l.quantity * l.base_qty / nullif(h.factor, 0) AS DECIMAL(30, 6))), 0) AS q,
                            sum(CAST(l.amount AS DECIMAL(30, 2))) AS c
                     FROM lines l JOIN head h ON h.item = l.item AND h.base_uofm IS NOT NULL GROUP BY ALL""",
        "rows_": f"""SELECT ItemName, {by}, unit, 'item' AS row_type, q::DOUBLE AS q, c::DOUBLE AS c FROM spend
                    UNION ALL SELECT NULL, NULL, NULL, 'Total', sum(q)::DOUBLE, sum(c)::DOUBLE FROM spend HAVING count(*) > 0""",
    }) + f"""
    SELECT ItemName, {by}, unit, row_type, {R('q', 4)} AS totalQuantity, c AS ExtCost, {R('c / nullif(q, 0)', 4)} AS CostPerUnit FROM rows_"""


def category_margins(week: int, period: int, year: int) -> str:
    rows = f"""SELECT store, CAST(amount AS DECIMAL(20, 2)) AS amount, itemid IN (SELECT p_partkey FROM part WHERE {RECIPE}) AS prep
               FROM stock_count WHERE type = 'Stock Count' AND category2 = 'Food Other'
               AND week = {week} AND period = {period} AND year = {year}"""
    def sheet(name, cond):
        return f"""SELECT '{name}' AS sheet, store, sum(amount)::DOUBLE AS amount FROM counted WHERE {cond} GROUP BY store
                   UNION ALL SELECT '{name}', 'Total', sum(amount)::DOUBLE FROM counted WHERE {cond}"""
    return ctes("stock_count", extra={"counted": rows}) + sheet("Prep Items", "prep") + " UNION ALL " + sheet("Purchase Items", "true")


def recipe_cost(as_of: str) -> str:
    return ctes("menu_cost", "restaurants") + f"""
    SELECT CAST(DATE '{as_of}' - 1 AS VARCHAR) AS date, CASE WHEN r.pos_store_id IS NULL THEN 0 ELSE r.id END AS id, r.name AS location,
           CASE WHEN itemid % 2 = 0 THEN 'Casual' ELSE 'Steakhouse' END AS concept, p_name || ' ' || p_partkey AS menu_item,
           {R('coalesce(cost, 0.0)', 4)} AS recipe_cost
    FROM menu_cost JOIN part ON p_partkey = itemid JOIN restaurants r ON r.id = store_id"""


MENU = f"""
    SELECT p_partkey AS menu_item_id, p_name || ' ' || p_partkey AS menu_item,
           CASE WHEN p_partkey % 2 = 0 THEN 'Casual' ELSE 'Steakhouse' END AS concept,
           CASE p_size % 3 WHEN 2 THEN 'Beverage' ELSE 'Food' END AS category_1,
           CASE p_type WHEN 'ECONOMY' THEN 'Entree' WHEN 'STANDARD' THEN 'Entree' WHEN 'SMALL' THEN 'Appetizer' WHEN 'MEDIUM' THEN 'Dessert'
                WHEN 'LARGE' THEN 'Salad' WHEN 'PROMO' THEN 'Sides' ELSE 'Other' END AS category_2,
           p_brand AS category_3,
           CASE WHEN 'R' IN s.flags THEN 'R' WHEN 'A' IN s.flags THEN 'A' ELSE 'N' END AS sales_account_id,
           CASE p_type WHEN 'ECONOMY' THEN 4 WHEN 'STANDARD' THEN 4 WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 6 WHEN 'LARGE' THEN 2
                ELSE 18 END AS category_2_sort
    FROM part JOIN (SELECT l_partkey, list(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY 1) s ON l_partkey = p_partkey
    WHERE {RECIPE}"""


def menu_items() -> str:
    return MENU


def unmapped_items() -> str:
    return f"""
    SELECT CAST(p_partkey AS VARCHAR) AS guid, p_name || ' ' || p_partkey AS name FROM part
    WHERE p_size % 11 = 0 AND p_partkey % 23 <> 0 AND p_partkey % 29 <> 0 AND p_partkey % 31 <> 0 AND p_brand <> 'Brand#13'
      AND p_partkey IN (SELECT l_partkey FROM lineitem)
      AND p_partkey NOT IN (SELECT menu_item_id FROM ({MENU}) m WHERE category_2_sort < 18)"""


def item_conversion() -> str:
    return """
    SELECT p_partkey AS itemid, p_name || ' ' || p_partkey AS name, CAST(p_size % 5 AS DOUBLE) AS weight_qty,
           CAST(p_size % 4 + 1 AS DOUBLE) AS volume_qty, CAST(p_size % 3 + 1 AS DOUBLE) AS each_qty,
           ['Weight', 'Volume', 'Each'][p_size % 3 + 1] AS measure_type
    FROM part WHERE p_partkey % 35 <> 0"""


def holidays() -> str:
    return """
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
    file AS (SELECT year(d) * 100 + month(d) AS holiday_key, 'Day ' || month(d) AS holiday_name,
                    CASE WHEN month(d) <> 2 THEN min(d) END AS holiday_date, month(d) % 3 AS holiday_offset
             FROM d WHERE year(d) >= 1998 GROUP BY year(d), month(d))
    SELECT holiday_key, holiday_name, CAST(holiday_date AS VARCHAR) AS holiday_date, holiday_offset FROM file
    UNION ALL
    SELECT -year(d), 'Old day', CAST(max(d) AS VARCHAR), 0 FROM d GROUP BY year(d)
    HAVING year(d) NOT IN (SELECT year(holiday_date) FROM file WHERE holiday_date IS NOT NULL)"""
