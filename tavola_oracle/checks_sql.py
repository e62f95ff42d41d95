"""Oracle SQL for the checks on invoice lines and the column work."""

from __future__ import annotations

from tavola_oracle.mart_sql import R, UNIT_CASE

UNIT_NAMES = "('Each', 'OZ-wt', 'OZ-fl', 'LB', 'Case-12', 'Bin')"
LINES = f"""
WITH l AS (
  SELECT l_orderkey AS transactionid, l_linenumber AS lineid, l_partkey AS itemid, {UNIT_CASE} AS uofm,
         CASE WHEN l_quantity % 25 <> 0 THEN l_quantity END AS quantity, l_extendedprice AS amount,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS twice FROM lineitem),
p AS (SELECT *, [x FOR x IN [CASE WHEN twice THEN 'duplicate key' END, CASE WHEN quantity IS NULL THEN 'null quantity' END,
                            CASE WHEN uofm NOT IN {UNIT_NAMES} THEN 'unmapped uofm' END] IF x IS NOT NULL] AS problems FROM l)
"""

CHECK_COUNTS = LINES + """
SELECT 'rows' AS problem, count(*) AS n FROM p
UNION ALL SELECT k, (SELECT count(*) FROM p WHERE list_contains(problems, k))
FROM (VALUES ('null quantity'), ('duplicate key'), ('unmapped uofm')) AS t(k)"""

QUARANTINED = LINES + """
SELECT transactionid, lineid, itemid, uofm, quantity, amount, array_to_string(problems, ', ') AS problems FROM p WHERE len(problems) > 0"""

ACCEPTED = LINES + """
SELECT uofm, count(*) AS lines, CAST(sum(CAST(amount AS DECIMAL(20, 2))) AS DOUBLE) AS amount FROM p WHERE len(problems) = 0 GROUP BY uofm"""

NULL_LINES = LINES + "SELECT transactionid, lineid, itemid, uofm, quantity, amount FROM l WHERE quantity IS NULL OR uofm IS NULL"

UNMAPPED = LINES + f"SELECT DISTINCT uofm FROM l WHERE uofm NOT IN {UNIT_NAMES}"

RECEIVED = """
WITH r AS (SELECT l_orderkey AS transactionid, l_linenumber AS linenumber, CASE l_returnflag WHEN 'R' THEN 'Beer' WHEN 'A' THEN 'Liquor' WHEN 'N' THEN 'Wine' END AS account,
                  CASE WHEN l_quantity % 10 = 0 THEN 0.0 ELSE l_quantity END AS quantity, l_extendedprice AS amount FROM lineitem)
SELECT transactionid, linenumber, CASE WHEN quantity > 45 THEN account || ' bulk' ELSE account END AS account,
       least(quantity, 45.0) AS quantity, amount, CAST(NULL AS VARCHAR) AS note FROM r"""

_MEASURES = f"""
WITH e AS (SELECT user_id % 20 AS store_id, event_type, CASE WHEN user_id % 11 <> 0 THEN {R('value', 2)} END AS value,
                  CASE WHEN event_type = 'purchase' THEN {R('value * 0.15', 2)} END AS tip FROM events)
"""
STORE_SUMS = _MEASURES + f"""
SELECT store_id, event_type, {R('coalesce(sum(value), 0)', 2)} AS value, {R('coalesce(sum(tip), 0)', 2)} AS tip FROM e GROUP BY ALL"""
STORE_MEANS = _MEASURES + f"SELECT store_id, event_type, {R('avg(value)', 6)} AS value, {R('avg(tip)', 6)} AS tip FROM e GROUP BY ALL"

ORDERS_CUSTOMER = """
SELECT o_custkey AS custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderpriority AS label,
       c_mktsegment AS label_customer, c_nationkey
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
WHERE CAST(o_orderdate AS DATE) >= DATE '1999-01-01' AND CAST(o_orderdate AS DATE) < DATE '1999-07-01'"""

ORDER_WEEKS = """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1),
w AS (SELECT *, floor(datediff('day', DATE '1995-01-01', date) / 7.0)::INTEGER AS week_index,
             (SELECT floor(min(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))) / 7.0)::INTEGER FROM orders) AS first FROM d),
e AS (SELECT *, CASE WHEN week_index > first THEN week_index - 1 END AS p FROM w)
SELECT CAST(date AS VARCHAR) AS date, orders, week_index, CAST(DATE '1995-01-01' + (p * 7 + 6) AS VARCHAR) AS prior_week_end,
       (1995 + floor(p / 52.0))::INTEGER AS prior_year, (floor((p - 52 * floor(p / 52.0)) / 4.0) + 1)::INTEGER AS prior_period,
       (p - 4 * floor(p / 4.0) + 1)::INTEGER AS prior_week FROM e WHERE p IS NOT NULL"""


def business_days() -> str:
    def iso(day: str) -> str:
        utc = f"(timezone('America/New_York', CAST({day} AS TIMESTAMP) + INTERVAL 4 HOUR) AT TIME ZONE 'UTC')"
        hours = f"CAST(date_diff('hour', CAST({day} AS TIMESTAMP) + INTERVAL 4 HOUR, {utc}) AS INTEGER)"
        return f"strftime({day}, '%Y-%m-%d') || 'T04:00:00.000-' || lpad(CAST({hours} AS VARCHAR), 2, '0') || '00'"
    return f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
    SELECT CAST(date AS VARCHAR) AS date, {iso('date')} AS start_date, {iso('(date + 1)')} AS end_date FROM d"""


PAYMENT_ROWS = f"""
WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'purchase'),
p AS (SELECT *, CASE WHEN k % 13 <> 0 THEN ['SWIPED', 'EMV_CHIP_SIGN', 'ONLINE', 'SAVED_CARD', 'PRE_AUTHED', 'FUTURE_ORDER',
                                           'INCREMENTAL_PRE_AUTHED'][k % 7 + 1] END AS mode FROM e)
SELECT 'p' || event_id AS guid, 'CREDIT' AS type, mode AS cardEntryMode, value AS amount, {R('value * 0.15', 2)} AS tipAmount,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS paid_at, strftime(ts, '%Y-%m-%d') AS paid_on, strftime(ts, '%m/%d/%y') AS day_text,
       'Store ' || (user_id % 20) AS location_name, 's' || (user_id % 7) AS server_guid, 'd' || (user_id % 3) AS device_id
FROM p WHERE mode IS NULL OR mode = 'SWIPED'"""

ITEM_LABELS = """
SELECT p_partkey AS itemid, p_name || CASE p_size % 3 WHEN 0 THEN ' Creme Brulee' WHEN 1 THEN ' Jalapenos' ELSE '' END AS label,
       concat_ws(' > ', p_brand, CASE WHEN p_size % 4 <> 0 THEN p_type END, p_name) AS path FROM part"""

FISCAL_TOTALS = """
WITH o AS (SELECT CAST(o_totalprice AS DECIMAL(20, 2)) AS total, o_orderstatus AS s,
                  floor(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 7.0)::INTEGER AS w FROM orders)
SELECT (1995 + floor(w / 52.0))::INTEGER AS year, (floor((w - 52 * floor(w / 52.0)) / 4.0) + 1)::INTEGER AS period,
       (w - 4 * floor(w / 4.0) + 1)::INTEGER AS week, count(*) AS orders, coalesce(sum(CASE WHEN s = 'F' THEN total END), 0)::DOUBLE AS closed,
       coalesce(sum(CASE WHEN s = 'O' THEN total END), 0)::DOUBLE AS open FROM o GROUP BY 1, 2, 3"""

STORE_DAYS = """
WITH d AS (SELECT unnest(generate_series(DATE '2000-01-01', DATE '2000-01-14', INTERVAL 1 DAY))::DATE AS date),
n AS (SELECT l_suppkey AS id, CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE l_partkey IN (SELECT p_partkey FROM part) GROUP BY 1, 2)
SELECT s_suppkey AS id, CAST(d.date AS VARCHAR) AS date, s_name AS name, coalesce(n, 0) AS lines
FROM supplier CROSS JOIN d LEFT JOIN n ON n.id = s_suppkey AND n.date = d.date"""
