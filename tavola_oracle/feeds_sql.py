"""Oracle SQL for the fact feeds and dimension loads."""

from __future__ import annotations

from tavola_oracle.mart_sql import R

END, START = "DATE '2000-01-01'", "DATE '1999-07-01'"


def transaction() -> str:
    return f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS transactionid, CAST(o_custkey % 100 AS VARCHAR) AS locationid,
           CAST(o_orderkey AS VARCHAR) AS template, CAST(o_custkey AS VARCHAR) AS companyid, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
           CASE WHEN o_orderdate < {START} THEN 'unposted' WHEN o_orderstatus = 'F' THEN 'AP Invoice' WHEN o_orderstatus = 'O' THEN 'Stock Count'
                WHEN o_orderstatus = 'P' THEN 'Waste Log' END AS type
    FROM orders"""


def transaction_detail() -> str:
    return f"""
    SELECT l_orderkey AS transactionid, l_linenumber AS lineid, l_suppkey AS locationid, l_partkey AS itemid, l_extendedprice AS amount,
           CASE WHEN o_orderdate >= {START} THEN l_quantity ELSE 0.0 END AS quantity, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE CAST(o_orderdate AS DATE) < {END}"""


def labor_detail() -> str:
    return f"""
    WITH e AS (SELECT event_id AS laborid, user_id % 20 AS location_id, CAST(ts AS DATE) AS dateworked, event_type AS jobtitle, value FROM events),
    sent AS (SELECT * FROM e WHERE laborid % 5 = 0 AND location_id < 10)
    SELECT laborid, location_id, CAST(dateworked AS VARCHAR) AS dateworked, jobtitle, {R('value', 2)} AS total,
           CASE WHEN laborid % 11 <> 0 THEN 'v1' END AS dailysalessummaryid
    FROM e WHERE laborid % 3 <> 0 AND laborid NOT IN (SELECT laborid FROM sent)
      AND (laborid % 11 = 0 OR (location_id, dateworked) NOT IN (SELECT (location_id, dateworked) FROM sent))
    UNION ALL
    SELECT laborid, location_id, CAST(dateworked AS VARCHAR), jobtitle, {R(R('value', 2) + ' + 1', 2)}, 'v2' FROM sent"""


def sales_detail() -> str:
    return f"""
    WITH o AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS loc, 'Item ' || o_custkey % 50 AS item, o_totalprice AS amount FROM orders),
    sent AS (SELECT *, 'v' || id % 2 AS v FROM o WHERE d >= {START}),
    old AS (SELECT *, 'v' || id % 3 AS v FROM o WHERE d < {START})
    SELECT id AS salesdetailid, CAST(d AS VARCHAR) AS date, loc AS location, item AS menuitem, amount, v AS dailysalessummaryid FROM sent
    UNION ALL SELECT id, CAST(d AS VARCHAR), loc, item, amount, v FROM old"""


def summaries(kind: str, key: str) -> str:
    return f"""
    WITH e AS (SELECT event_id AS k, user_id % 20 AS loc, CAST(ts AS DATE) AS d, {R('value', 2)} AS amount FROM events WHERE event_type = '{kind}'),
    sent AS (SELECT *, CASE WHEN loc % 4 = 0 THEN 'a' ELSE 'b' END AS v FROM e WHERE k % 3 = 0),
    left_ AS (SELECT * FROM e WHERE k % 2 = 0 AND k % 3 <> 0 AND (loc % 4 = 0 OR (loc, d) NOT IN (SELECT (loc, d) FROM sent)))
    SELECT k AS {key}, loc AS location, CAST(d AS VARCHAR) AS date, amount, 'a' AS dailysalessummaryid FROM left_
    UNION ALL SELECT k, loc, CAST(d AS VARCHAR), amount, v FROM sent"""


def dss_list() -> str:
    return f"SELECT DISTINCT date, dailysalessummaryid, location, salespaymentid FROM ({summaries('purchase', 'salespaymentid')}) q"


def job_titles() -> str:
    return """
    SELECT n_nationkey AS job_title_id, n_name AS name,
           CASE WHEN n_nationkey % 4 <> 3 AND n_regionkey * 2 IN (SELECT r_regionkey FROM region) THEN CAST(n_regionkey * 2 AS VARCHAR) END AS glaccountid
    FROM nation"""


def sales_accounts() -> str:
    return """
    SELECT p_brand || '/' || p_type AS sales_account_id, p_brand || '/' || p_type AS name,
           arg_max(CASE WHEN p_size % 5 = 0 THEN p_type ELSE p_type || ' - ' || p_brand END, p_partkey) AS service_type,
           nullif(arg_max(CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 2 = 0 THEN 'Lunch' ELSE 'Dinner' END, p_partkey), '') AS day_part,
           nullif(arg_max(CASE p_size % 3 WHEN 1 THEN 'Beer' WHEN 2 THEN 'Liquor' ELSE '' END, p_partkey), '') AS gl_account
    FROM part GROUP BY p_brand, p_type"""


def purchase_items() -> str:
    return """
    SELECT p_partkey AS item_id, p_name || ' ' || p_partkey AS name,
           CASE WHEN p_partkey % 3 = 0 THEN 'kept' WHEN p_size % 7 <> 0 THEN p_type END AS category1,
           CASE WHEN p_size % 6 <> 0 THEN p_brand END AS category2, p_size % 2 = 0 AS key_item
    FROM part"""


def units() -> str:
    bases = "VALUES ('Each', 'Each', -1), ('OZ-wt', 'Weight', -2), ('OZ-fl', 'Volume', -3)"
    return f"""
    WITH RECURSIVE b AS (SELECT * FROM ({bases}) AS t(name, kind, id)),
    k AS (SELECT DISTINCT p_partkey AS k FROM part),
    u AS (
      SELECT k AS uofm_id, 'U' || k AS name,
             CASE WHEN k % 100 = 50 THEN 4.0::DOUBLE WHEN k % 100 = 51 THEN CASE WHEN (k - 1) % 200 = 50 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END
                  WHEN k % 100 = 85 THEN 0.0::DOUBLE ELSE (k % 3 + 2)::DOUBLE END AS equivalent_qty,
             CASE WHEN k <= 3 THEN ['Each', 'OZ-wt', 'OZ-fl'][k % 3 + 1] WHEN k % 100 = 50 THEN 'U' || (k + 1) WHEN k % 100 = 51 THEN 'U' || (k - 1)
                  WHEN k % 100 = 75 THEN NULL WHEN k % 100 = 95 THEN 'Unheard' ELSE 'U' || (k // 4) END AS equivalent_uofm,
             ['Each', 'Weight', 'Volume'][k % 3 + 1] AS measure_type,
             CASE WHEN k <= 3 THEN ['Each', 'OZ-wt', 'OZ-fl'][k % 3 + 1] WHEN k % 4 = 0 AND k <= 12 THEN ['Each', 'OZ-wt', 'OZ-fl'][k // 4 % 3 + 1]
                  WHEN k % 37 = 0 THEN 'Each' END AS base_uofm,
             CASE WHEN k <= 3 THEN k % 3 + 2 WHEN k % 4 = 0 AND k <= 12 THEN (k % 3 + 2) * (k // 4 % 3 + 2)
                  WHEN k % 37 = 0 THEN 1 END::DOUBLE AS base_qty, k % 9 <> 0 AS active FROM k
      UNION ALL SELECT id, name, 1.0::DOUBLE, NULL, kind, name, 1.0::DOUBLE, true FROM b),
    walk(name, here, factor, path) AS (
      SELECT name, name, 1.0::DOUBLE, [name] FROM u
      UNION ALL
      SELECT w.name, d.equivalent_uofm, w.factor * d.equivalent_qty, list_append(w.path, d.equivalent_uofm)
      FROM walk w JOIN u d ON d.name = w.here
      WHERE d.uofm_id >= 0 AND d.equivalent_uofm IS NOT NULL AND d.equivalent_qty > 0 AND NOT list_contains(w.path, d.equivalent_uofm)),
    e AS (SELECT name, arg_max(here, len(path)) AS here, arg_max(factor, len(path)) AS factor FROM walk GROUP BY name),
    s AS (
      SELECT e.name, d.uofm_id < 0 AS found, e.here, e.factor,
             CASE WHEN d.uofm_id < 0 THEN 'ok' WHEN d.name IS NULL THEN 'no base'
                  WHEN d.equivalent_uofm IS NULL THEN 'no base'
                  WHEN NOT d.equivalent_qty > 0 THEN CASE WHEN e.here = e.name THEN 'invalid quantity' ELSE 'no base' END
                  WHEN d.equivalent_uofm <> e.name THEN 'leads into loop'
                  WHEN abs(ln(e.factor * d.equivalent_qty)) <= 1e-9 THEN 'loop' ELSE 'contradictory loop' END AS status,
             CASE WHEN d.equivalent_uofm = e.name AND d.equivalent_qty > 0 THEN e.factor * d.equivalent_qty END AS loop_factor
      FROM e LEFT JOIN u d ON d.name = e.here)
    SELECT u.*, CASE WHEN found THEN here END AS root, CASE WHEN found THEN factor END AS factor, status,
           round(loop_factor, 9) AS loop_factor,
           CASE WHEN found THEN base_uofm = here AND base_qty = factor END AS stated_ok
    FROM u JOIN s USING (name)"""
