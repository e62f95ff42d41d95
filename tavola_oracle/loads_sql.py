"""Oracle SQL for the dimension and report loads."""

from __future__ import annotations

from tavola_oracle import cost_sql, dims_sql, pos_sql, reports_sql


def _load(rows: str, key: str) -> str:
    """Table after an upsert: the batch, and the ids of the table that it does not hold."""
    return f"""WITH b AS ({rows})
    SELECT * FROM b UNION ALL BY NAME SELECT * REPLACE (-{key} - 1 AS {key}) FROM b WHERE {key} % 5 = 0"""


GL_ACCOUNTS = _load("""SELECT n_nationkey AS glaccountid, n_name AS name, '4' || lpad(n_nationkey::VARCHAR, 3, '0') AS glaccountnumber,
    CASE WHEN n_nationkey % 2 = 0 THEN 'Sales' ELSE 'Cost' END AS gltype FROM nation""", "glaccountid")
LOCATIONS = _load("""SELECT s_suppkey AS locationid, s_name AS name,
    CASE WHEN s_suppkey % 7 <> 0 THEN lpad(s_suppkey::VARCHAR, 4, '0') END AS locationnumber FROM supplier""", "locationid")
COMPANIES = _load("SELECT c_custkey AS companyid, c_name AS name FROM customer", "companyid")
ITEMS = _load("""SELECT p_partkey AS itemid, p_name AS name, CASE WHEN p_size % 7 <> 0 THEN ['Food', 'LBW', 'Other'][p_size % 3 + 1] END AS category1,
    CASE WHEN p_size % 6 <> 0 THEN p_type END AS category2, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS category3 FROM part""", "itemid")


def _named(value: str, n: int, name: str) -> str:
    return f"CASE WHEN p_size % {n} <> 0 THEN {value} END AS {name}"


PURCHASE_ITEMS = f"""
SELECT p_partkey AS item_id, p_name || ' ' || p_partkey AS item_name, {_named("'Each'", 2, 'reporting_uofm')}, {_named("'LB'", 3, 'inventory_uofm')},
       {_named('p_type', 7, 'category1')}, {_named('p_brand', 6, 'category2')}, {_named('p_name', 5, 'category3')},
       {_named("'Food Cost'", 4, 'cost_account')}, {_named("'Inventory'", 8, 'inventory_account')}, {_named("'Waste'", 9, 'waste_account')},
       p_size % 2 = 0 AS key_item, (p_size % 5)::DOUBLE AS weight_qty, {_named("'OZ-wt'", 10, 'weight_uofm')},
       (p_size % 4 + 1)::DOUBLE AS volume_qty, {_named("'OZ-fl'", 11, 'volume_uofm')}, (p_size % 3 + 1)::DOUBLE AS each_qty,
       {_named("'Each'", 12, 'each_uofm')}, CASE WHEN p_size % 2 = 0 THEN 'Weight' ELSE 'Volume' END AS measure_type, p_size % 9 <> 0 AS active
FROM part"""

RECIPES = f"""
SELECT 'PREP ' || p_name || ' ' || p_partkey AS recipe_name, 'Each' AS reporting_uofm,
       CASE WHEN p_partkey % 2 = 0 THEN 'Each' ELSE 'OZ-wt' END AS yield_uofm, (p_partkey % 3 + 1)::DOUBLE AS yield_qty, p_partkey AS recipe_id
FROM part WHERE {reports_sql.RECIPE}"""

INVENTORY_HEADERS = """
SELECT o_orderkey AS id, 'Count ' || o_orderkey AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'Approved' ELSE 'Open' END AS status,
       strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey % 4 = 0 AS is_gl_posting, o_totalprice AS total_amount,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 3 ELSE 0 END AS alerts_count
FROM orders WHERE o_orderstatus = 'O'"""

INVOICE_HEADERS = """
SELECT o_orderkey AS id, 'Invoice ' || o_orderkey AS name, lpad(o_orderkey::VARCHAR, 8, '0') AS number, o_totalprice AS amount,
       o_orderpriority AS status, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey % 3 = 0 AS is_paid
FROM orders WHERE o_orderstatus = 'F'"""


def product_mix_table() -> str:
    return f"""
    SELECT * REPLACE (CASE WHEN store_id % 3 = 0 THEN qty_sold ELSE -1.0 END AS qty_sold),
           CASE WHEN store_id % 3 = 0 THEN '2001-08-01' ELSE '2000-01-01' END AS last_update
    FROM ({pos_sql.product_mix()}) q WHERE store_id % 2 = 0 OR store_id % 3 = 0"""


def menu_items_table() -> str:
    return f"""SELECT * FROM ({reports_sql.MENU}) q
    UNION ALL SELECT * REPLACE (-menu_item_id - 1 AS menu_item_id) FROM ({reports_sql.MENU}) r WHERE menu_item_id % 7 = 0"""


def budget_table() -> str:
    return f"""SELECT * FROM ({dims_sql.budget_unpivot()}) q
    UNION ALL SELECT * REPLACE (year - 100 AS year) FROM ({dims_sql.budget_unpivot()}) r WHERE period = 13"""


def weekly_cost_table(year: int, period: int, week: int) -> str:
    return f"""SELECT * FROM ({cost_sql.weekly_item_base_cost(year, period, week)}) q
    UNION ALL SELECT * FROM ({cost_sql.weekly_item_base_cost(year, period, week - 1)}) r"""
