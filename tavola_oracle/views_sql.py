"""Oracle SQL for the views (VW-*), straight from the raw tables.

Units, categories and fiscal fields are worked out from the numbers they are
derived from; picks are minima of structs and listings are counted, so none of
this repeats how the Spark side plans the views.
"""

from __future__ import annotations

from tavola_oracle.mart_sql import R

AS_OF = "2001-08-01"

# l_linenumber - 1 -> (unit, base unit, base quantity); line 7 has no unit row
UNIT = "['Each', 'OZ-wt', 'OZ-fl', 'LB', 'Case-12', 'Bin', 'Unmapped'][l_linenumber]"
BASE_UNIT = "['Each', 'OZ-wt', 'OZ-fl', 'OZ-wt', 'Each', 'Each'][l_linenumber]"
BASE_QTY = "[1.0, 1.0, 1.0, 16.0, 12.0, 0.0][l_linenumber]::DOUBLE"

LINES = f"""
WITH booked AS (
  SELECT CAST(o_orderdate AS DATE) AS day, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS n,
         o_orderstatus AS status, lineitem.*, p_size, p_type, p_name || ' ' || p_partkey AS item, s_name AS store,
         {UNIT} AS unit, {BASE_UNIT} AS base_unit, {BASE_QTY} AS base
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
lines AS (
  SELECT *, floor(n / 7.0)::INTEGER AS wk, floor(n / 28.0)::INTEGER AS pd, floor(n / 364.0)::INTEGER AS yr FROM booked),
listed AS (
  SELECT l_partkey AS lp, count(DISTINCT l_suppkey) AS stores FROM lines WHERE status = 'O' AND p_size % 3 = 0 GROUP BY 1)
"""
WEEK, PERIOD, YEAR, DOW = "wk - 4 * pd + 1", "pd - 13 * yr + 1", "1995 + yr", "n - 7 * wk + 1"


def current_base_cost(gl_name: str, pick: str = "first") -> str:
    flag = {"Beer": "R", "Liquor": "A", "Wine": "N"}[gl_name]
    best = "max" if pick == "last" else "min"
    return LINES + f"""
    , one AS (
      SELECT l_suppkey, store, item, {best}({{'day': day, 'k': l_orderkey, 'a': l_extendedprice, 'q': l_quantity, 'u': unit}}) AS x,
             [{{'u': 'Each', 'b': 'Each', 'n': 1}}, {{'u': 'OZ-wt', 'b': 'OZ-wt', 'n': 1}}, {{'u': 'OZ-fl', 'b': 'OZ-fl', 'n': 1}},
              {{'u': 'LB', 'b': 'OZ-wt', 'n': 16}}, {{'u': 'Case-12', 'b': 'Each', 'n': 12}}, {{'u': 'Bin', 'b': 'Each', 'n': 0}}] AS units
      FROM lines WHERE status = 'F' AND l_returnflag = '{flag}' AND l_linenumber < 7 GROUP BY ALL),
    known AS (SELECT *, [u FOR u IN units IF u.u = x.u][1] AS unit FROM one)
    SELECT l_suppkey AS store_id, ['Casual', 'Steakhouse'][l_suppkey % 2 + 1] AS concept, store, item, x.u AS uofm,
           {R('x.a / nullif(x.q, 0)', 2)} AS amount, unit.b AS base_uofm, {R('x.a / nullif(x.q, 0) / nullif(unit.n, 0)', 4)} AS base_amount
    FROM known"""


def stockcount_category_totals() -> str:
    return LINES + f"""
    SELECT day AS date, {WEEK} AS week, {PERIOD} AS period, {YEAR} AS year, l_suppkey AS store_id, store,
           CASE l_returnflag WHEN 'R' THEN 'Beer' WHEN 'A' THEN 'Liquor' WHEN 'N' THEN 'Wine' END AS account,
           ['Food', 'LBW', 'Other'][p_size % 3 + 1] AS category1,
           {R('sum(l_extendedprice * (1 - l_discount))', 2)} AS previous, {R('sum(l_extendedprice)', 2)} AS amount
    FROM lines WHERE status = 'O' GROUP BY ALL"""


def stockcount_conversion(as_of: str = AS_OF) -> str:
    return LINES + f"""
    SELECT day AS date, {DOW} AS dow, {WEEK} AS week, {PERIOD} AS period, {YEAR} AS year, l_suppkey AS store_id, store,
           'Stock Count' AS type, item, unit AS uofm, l_quantity AS quantity, base_unit AS base_uofm, base AS base_qty,
           (p_size % 5)::DOUBLE AS weight_qty,
           {R('coalesce(l_quantity * base / nullif(p_size % 5, 0), 0)', 4)} AS each_conversion
    FROM lines WHERE status = 'O' AND p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') AND l_linenumber <= 6
      AND day >= DATE '{as_of}' - INTERVAL 12 MONTH"""


def stockcount_monthly(as_of: str = AS_OF, days: int = 30) -> str:
    return LINES + f"""
    , pairs AS (SELECT l_partkey, l_suppkey, any_value(item) AS item,
                       map_from_entries(list((day, total)) FILTER (total IS NOT NULL)) AS counted
                FROM (SELECT l_partkey, l_suppkey, item, day, sum(l_quantity) AS total FROM lines
                      WHERE status = 'O' AND p_size % 3 = 0 GROUP BY ALL) GROUP BY ALL)
    SELECT date, item_id, item_name, store_id, {R('total', 4)} AS count_total FROM (
      SELECT unnest([DATE '{as_of}' - i::INTEGER FOR i IN range({days})]) AS date, l_partkey AS item_id, item AS item_name,
             l_suppkey AS store_id, coalesce(counted[date], 0.0) AS total FROM pairs)"""


def stockcount_purchases(as_of: str = AS_OF) -> str:
    return LINES + f"""
    SELECT DISTINCT l_orderkey AS transactionid, day AS date, {DOW} AS dow, {WEEK} AS week, {PERIOD} AS period, {YEAR} AS year,
           l_suppkey AS store_id, store, item, l_quantity AS quantity, unit AS uofm,
           {R('base * l_quantity / nullif(p_size % 5, 0)', 4)} AS unit_count
    FROM lines SEMI JOIN listed ON lp = l_partkey
    WHERE status = 'F' AND l_linenumber <= 6 AND l_quantity > 0 AND day >= DATE '{as_of}' - INTERVAL 12 MONTH"""


def stockcount_waste(fanout: bool = False) -> str:
    times = "stores" if fanout else "1"
    return LINES + f"""
    , wasted AS (SELECT day, n, wk, pd, yr, l_suppkey, l_partkey, store, item, unit, base, base_unit, sum(l_quantity) AS q
                 FROM lines WHERE status = 'P' AND l_linenumber <= 6 GROUP BY ALL)
    SELECT day AS date, {DOW} AS dow, {WEEK} AS week, {PERIOD} AS period, {YEAR} AS year, l_suppkey AS store_id, store, item,
           unit AS uofm, {R(f'q * {times}', 4)} AS quantity, base_unit AS base_uofm, {R(f'q * {times} * base', 4)} AS base_qty
    FROM wasted JOIN listed ON lp = l_partkey"""
