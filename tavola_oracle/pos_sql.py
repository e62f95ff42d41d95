"""Oracle SQL for the POS jobs, computed straight from the events table
(the Spark side goes through JSON documents and back)."""

from __future__ import annotations

from tavola_oracle.mart_sql import R

E = """
WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS bdate,
                  user_id % 20 AS store_id FROM events)
"""


def payment_summary() -> str:
    modes = ["SWIPED", "EMV_CHIP_SIGN", "ONLINE", "SAVED_CARD", "PRE_AUTHED", "FUTURE_ORDER",
             "INCREMENTAL_PRE_AUTHED"]
    arr = "[" + ", ".join(f"'{m}'" for m in modes) + "]"
    return E + f"""
    , p AS (SELECT 'Store ' || CAST(user_id % 20 AS VARCHAR) AS location_name,
                   CASE WHEN k % 13 <> 0 THEN ({arr})[k % 7 + 1] END AS cardEntryMode, value AS amount
            FROM e WHERE event_type = 'purchase')
    SELECT location_name, cardEntryMode, {R('sum(amount)', 2)} AS total_amount, count(amount) AS count
    FROM p WHERE cardEntryMode = 'SWIPED'
    GROUP BY 1, 2"""


def product_mix() -> str:
    half = R("value / 2", 2)
    disc = f"CASE WHEN event_type = 'purchase' THEN {R('value * 0.1', 2)} ELSE 0.0 END"
    return E + f"""
    , sel AS (SELECT e.*, 'Item ' || k || CASE WHEN k % 19 = 0 THEN ' Allergy' ELSE '' END AS called
              FROM e, unnest(CASE WHEN k % 7 = 0 THEN [1, 2, 3] ELSE [1] END) AS t(copy)
              WHERE event_type NOT IN ('error', 'signup'))
    , rows AS (
        SELECT 'g' || k AS item_guid, bdate, store_id, called AS item_name,
               CASE WHEN k % 5 = 0 THEN 0.0 ELSE 1.0 END AS qty, value AS menu, value AS gross,
               value AS net, {disc} AS discount
        FROM sel WHERE k % 6 <> 0
        UNION ALL
        SELECT 'm' || k, bdate, store_id, 'Size ' || (k % 4), 1.0, {half}, {half}, {half}, 0.0
        FROM sel WHERE k % 3 = 0 AND k % 2 <> 0
        UNION ALL
        SELECT 'n' || k, bdate, store_id, 'Extra ' || k, 1.0, 0.5, 0.5, 0.5, 0.0
        FROM sel WHERE k % 3 = 0 AND k % 2 <> 0
        UNION ALL
        SELECT 's' || k, bdate, store_id, 'Side', 1.0, 0.25, 0.25, 0.25, 0.0
        FROM sel WHERE k % 9 = 0 AND k % 2 <> 0
        UNION ALL
        SELECT 's' || k, bdate, store_id, called || ' Side', 1.0, 0.25, 0.25, 0.25, {disc}
        FROM sel WHERE k % 18 = 0
        UNION ALL
        SELECT 'm' || k, bdate, store_id, called || ' Size ' || (k % 4), 1.0, {half} / 1.0,
               {half}, {half}, {disc}
        FROM sel WHERE k % 6 = 0 AND {half} <> 0)
    SELECT item_guid, CAST(bdate AS VARCHAR) AS date, store_id, item_name,
           {R('sum(qty)', 4)} AS qty_sold, {R('avg(menu)', 4)} AS menu_item_price,
           {R('sum(gross)', 4)} AS gross_item_amt, {R('sum(net)', 4)} AS net_item_amt,
           {R('sum(discount)', 4)} AS discount_amt
    FROM rows WHERE NOT regexp_matches(item_name, 'Allergy$') GROUP BY item_guid, bdate, store_id, rows.item_name
    QUALIFY row_number() OVER (PARTITION BY item_guid, bdate, store_id ORDER BY rows.item_name DESC) = 1"""
