"""Oracle SQL for the small record jobs."""

from __future__ import annotations

MENU_TREE = """
WITH x AS (SELECT *, p_name || ' ' || p_partkey AS n FROM part),
r AS (SELECT p_partkey AS menu_id, p_brand AS menu, p_brand || ' > ' || p_type AS path, n AS item, p_size FROM x
      UNION ALL SELECT p_partkey, p_brand, p_brand || ' > ' || p_type || ' > Size ' || p_size, 'Large ' || n, p_size FROM x WHERE p_size % 2 = 0)
SELECT menu_id, menu, path, item, upper(item) AS pos_name, CASE WHEN p_size % 3 <> 0 THEN lower(item) END AS kitchen_name FROM r"""

DICTIONARY = """
SELECT json_extract_string(props, '$.k') AS id, 'Item ' || arg_max(event_type, {'t': ts, 'e': event_id}) AS name FROM events GROUP BY 1"""

STORE_CONFIG = """
SELECT s_suppkey AS store_id, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS name,
       CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 3 = 0 THEN '' ELSE 'Site ' || s_suppkey END AS location_name,
       CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 4 = 0 THEN '' ELSE lpad(s_suppkey::VARCHAR, 6, '0') END AS location_code
FROM supplier"""

DAILY_TOTALS = """
SELECT user_id % 20 AS store_id, strftime(ts, '%Y-%m-%d') AS date, CAST(sum(CAST(value AS DECIMAL(20, 4))) AS DOUBLE) AS net_sales,
       CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS guest_count FROM events GROUP BY 1, 2"""

PAYMENT_IDS = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       sum(CASE WHEN event_type = 'purchase' AND event_id % 7 = 0 THEN 2 ELSE 1 END)::BIGINT AS listed, count(DISTINCT event_id) AS ids
FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1"""

PART_B = """
WITH n AS (SELECT p_partkey AS itemid, p_size, p_type, p_brand, p_name FROM part),
b AS (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size % 2 = 0)
SELECT itemid, CASE WHEN p_size % 4 = 0 THEN p_name ELSE p_type || ' ' || p_brand || ' ' || p_name END AS name,
       CASE WHEN p_size % 4 = 0 OR b.p_type IS NOT NULL THEN p_name ELSE n.p_brand || ' ' || p_name END AS part_b
FROM n LEFT JOIN b USING (p_type, p_brand)"""
