"""DuckDB SQL for the mart tables, used by the oracle queries.

Mirrors ``tavola.sources.mart`` expression by expression over the raw
parquet views (region, nation, customer, supplier, part, orders, lineitem,
events). ``ctes(...)`` returns a ``WITH`` clause holding the requested mart
tables and everything they depend on.
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    """Round like Spark's ``round`` on a double: HALF_UP on the shortest
    decimal text of the value."""
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), {n}) AS DOUBLE)"


def stable(sql: str, *text_cols: str) -> str:
    """Render DATE / TIMESTAMP output columns as ISO text (as the Spark side
    does), so both engines hand back the same Python values."""
    if not text_cols:
        return sql
    rep = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def NULLIF_DIV(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(({b}), 0))"


UNIT_CASE = ("CASE l_linenumber WHEN 1 THEN 'Each' WHEN 2 THEN 'OZ-wt' WHEN 3 THEN 'OZ-fl' "
             "WHEN 4 THEN 'LB' WHEN 5 THEN 'Case-12' WHEN 6 THEN 'Bin' WHEN 7 THEN 'Unmapped' END")

_DEFS: dict[str, tuple[tuple[str, ...], str]] = {
    "units": ((), """
        SELECT * FROM (VALUES (1, 'Each', 'Each', 1.0::DOUBLE), (2, 'OZ-wt', 'OZ-wt', 1.0::DOUBLE),
          (3, 'OZ-fl', 'OZ-fl', 1.0::DOUBLE), (4, 'LB', 'OZ-wt', 16.0::DOUBLE),
          (5, 'Case-12', 'Each', 12.0::DOUBLE), (6, 'Bin', 'Each', 0.0::DOUBLE))
          AS u(uofm_id, name, base_uofm, base_qty)"""),
    "glaccount": ((), """
        SELECT * FROM (VALUES ('R', 'Beer'), ('A', 'Liquor'), ('N', 'Wine')) AS g(glaccountid, name)"""),
    "calendar": ((), """
        SELECT CAST(DATE '1995-01-01' + CAST(n AS INTEGER) AS DATE) AS date,
               CAST(n - 7 * wk + 1 AS INTEGER) AS dow,
               CAST(wk - 4 * pd + 1 AS INTEGER) AS week,
               CAST(pd - 13 * yr + 1 AS INTEGER) AS period,
               CAST(1995 + yr AS INTEGER) AS year,
               CAST(wk AS INTEGER) AS week_index,
               CAST(pd AS INTEGER) AS period_index
        FROM (SELECT n, floor(n / 7.0) AS wk, floor(n / 28.0) AS pd, floor(n / 364.0) AS yr
              FROM (SELECT unnest(range(7 * floor(lo / 7.0)::BIGINT, 7 * floor(hi / 7.0)::BIGINT + 7)) AS n
                    FROM (SELECT min(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))) AS lo,
                                 max(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))) AS hi
                          FROM orders)))"""),
    "restaurants": ((), """
        SELECT s_suppkey AS id, s_suppkey AS locationid, s_name AS name,
               CASE WHEN s_suppkey % 2 = 0 THEN 'Casual' ELSE 'Steakhouse' END AS concept,
               'America/New_York' AS timezone,
               CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE 'T' || CAST(s_suppkey AS VARCHAR) END AS pos_store_id
        FROM supplier"""),
    "item": ((), """
        SELECT p_partkey AS itemid, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name,
               CASE p_size % 3 WHEN 0 THEN 'Food' WHEN 1 THEN 'LBW' WHEN 2 THEN 'Other' END AS category1,
               CASE p_type WHEN 'ECONOMY' THEN 'Beef' WHEN 'SMALL' THEN 'Pork'
                           WHEN 'MEDIUM' THEN 'Seafood' ELSE 'Food Other' END AS category2,
               p_brand AS category3
        FROM part"""),
    "item_conversion": ((), """
        SELECT p_partkey AS itemid, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name,
               CAST(p_size % 5 AS DOUBLE) AS weight_qty,
               CAST(p_size % 4 + 1 AS DOUBLE) AS volume_qty,
               CAST(p_size % 3 + 1 AS DOUBLE) AS each_qty
        FROM part"""),
    "txn": ((), """
        SELECT o_orderkey AS transactionid, o_orderdate AS date,
               CASE o_orderstatus WHEN 'F' THEN 'AP Invoice' WHEN 'O' THEN 'Stock Count'
                                  WHEN 'P' THEN 'Waste Log' END AS type
        FROM orders"""),
    "txn_detail": ((), f"""
        SELECT l_orderkey AS transactionid, l_linenumber AS lineid, l_suppkey AS locationid,
               l_partkey AS itemid, l_returnflag AS glaccountid,
               {UNIT_CASE} AS unitofmeasurename,
               l_quantity AS quantity, l_extendedprice AS amount,
               l_extendedprice * (1 - l_discount) AS previouscounttotal, l_discount AS discount
        FROM lineitem"""),
    "detail_rows": (("txn", "txn_detail", "restaurants", "item", "calendar", "units", "glaccount"), """
        SELECT td.transactionid, td.lineid, CAST(t.date AS DATE) AS date, c.dow, c.week, c.period,
               c.year, c.week_index, c.period_index, r.id, r.name AS store, t.type,
               gl.name AS account, td.itemid, i.name AS item, i.category1, i.category2,
               td.unitofmeasurename AS uofm, td.quantity, td.amount,
               td.previouscounttotal AS previous_amount, um.base_uofm, um.base_qty, td.discount
        FROM txn_detail td
        JOIN txn t ON t.transactionid = td.transactionid
        JOIN restaurants r ON r.locationid = td.locationid
        JOIN item i ON i.itemid = td.itemid
        JOIN calendar c ON c.date = CAST(t.date AS DATE)
        LEFT JOIN units um ON um.name = td.unitofmeasurename
        LEFT JOIN glaccount gl ON gl.glaccountid = td.glaccountid"""),
    "purchases": (("detail_rows",), "SELECT * FROM detail_rows WHERE type = 'AP Invoice'"),
    "stock_count": (("detail_rows",), "SELECT * FROM detail_rows WHERE type <> 'AP Invoice'"),
    "inv_items": (("stock_count",), """
        SELECT DISTINCT itemid AS id, item AS item_name, id AS store_id
        FROM stock_count WHERE type = 'Stock Count' AND category1 = 'Food'"""),
    "inv_count": (("stock_count",), """
        SELECT itemid AS item_id, id AS store_id, date AS trans_date, sum(quantity) AS count_total
        FROM stock_count WHERE type = 'Stock Count' GROUP BY 1, 2, 3"""),
    "product_mix": (("restaurants",), """
        SELECT a.store_id, a.itemid, a.qty, a.price, a.sales,
               p_name || ' ' || CAST(p_partkey AS VARCHAR) AS menu_item,
               CASE WHEN p_size % 11 = 0 THEN NULL
                    ELSE CASE p_size % 3 WHEN 2 THEN 'Beverage' ELSE 'Food' END END AS cat1,
               CASE WHEN p_size % 11 = 0 THEN NULL
                    ELSE CASE p_type WHEN 'ECONOMY' THEN 'Entree' WHEN 'STANDARD' THEN 'Entree'
                         WHEN 'SMALL' THEN 'Appetizer' WHEN 'MEDIUM' THEN 'Dessert'
                         WHEN 'LARGE' THEN 'Salad' WHEN 'PROMO' THEN 'Sides' ELSE 'Other' END END AS cat2,
               CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_brand END AS cat3,
               r.name AS location, r.concept
        FROM (SELECT l_suppkey AS store_id, l_partkey AS itemid, sum(l_quantity) AS qty,
                     avg(l_extendedprice / NULLIF(l_quantity, 0)) AS price,
                     sum(l_extendedprice) AS sales
              FROM lineitem GROUP BY 1, 2) a
        JOIN part ON p_partkey = a.itemid
        JOIN restaurants r ON r.id = a.store_id"""),
    "menu_cost": ((), """
        SELECT l_suppkey AS store_id, l_partkey AS itemid,
               avg(CASE WHEN l_linestatus = 'F'
                        THEN l_extendedprice * (l_discount + l_tax) / NULLIF(l_quantity, 0) END) AS cost
        FROM lineitem GROUP BY 1, 2"""),
}


def ctes(*names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``WITH`` clause defining ``names`` (and their dependencies) in order;
    ``extra`` adds query-specific CTEs after the mart ones."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _DEFS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({_DEFS[n][1]})" for n in order]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"
