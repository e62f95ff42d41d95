"""Oracle SQL for the cost jobs (DOM-05, DOM-06)."""

from __future__ import annotations

from tavola_oracle.mart_sql import R, ctes

NEWEST_DESC = "date DESC, transactionid DESC, lineid DESC, amount DESC, quantity DESC"
OLDEST_ASC = "date ASC, transactionid ASC, lineid ASC, amount ASC, quantity ASC"


def latest_item_price() -> str:
    return ctes("purchases") + f"""
    , lp AS (SELECT *, row_number() OVER (PARTITION BY id, item ORDER BY {NEWEST_DESC}) AS rn
             FROM purchases)
    SELECT CAST(date AS VARCHAR) AS date, id, store, itemid, item, quantity, uofm, amount,
           base_uofm, base_qty, {R('amount / quantity / NULLIF(base_qty, 0)', 4)} AS base_cost
    FROM lp WHERE rn = 1 AND quantity <> 0 AND base_uofm IS NOT NULL"""


def _unit_cost(a: str, q: str, b: str) -> str:
    return f"CASE WHEN {q} > 0 AND {b} > 0 THEN {a} / {q} / {b} ELSE 0.0 END"


def _weekly(week_filter: str) -> str:
    """Range-join form: every (store, item, week) with its newest costed
    purchase and its oldest stock count up to the week's last day."""
    return ctes("purchases", "stock_count", "restaurants", "calendar") + f"""
    , weeks AS (SELECT week_index, date AS week_end, year, period, week, period_index
                FROM calendar WHERE dow = 7 AND {week_filter})
    , stores AS (SELECT id FROM restaurants WHERE pos_store_id IS NOT NULL)
    , p AS (SELECT *, {_unit_cost('amount', 'quantity', 'base_qty')} AS base_cost FROM purchases
            WHERE category1 IN ('Food', 'LBW') AND id IN (SELECT id FROM stores))
    , sc AS (SELECT *, {_unit_cost('amount', 'quantity', 'base_qty')} AS base_cost FROM stock_count
             WHERE type = 'Stock Count' AND id IN (SELECT id FROM stores))
    , pw AS (SELECT w.week_index, p.id, p.itemid, p.date, p.item, p.base_uofm, p.base_cost,
                    row_number() OVER (PARTITION BY w.week_index, p.id, p.itemid
                                       ORDER BY p.{NEWEST_DESC.replace(', ', ', p.')}) AS rn
             FROM weeks w JOIN p ON p.date <= w.week_end)
    , sw AS (SELECT w.week_index, sc.id, sc.itemid, sc.date, sc.item, sc.base_uofm, sc.base_cost,
                    row_number() OVER (PARTITION BY w.week_index, sc.id, sc.itemid
                                       ORDER BY sc.{OLDEST_ASC.replace(', ', ', sc.')}) AS rn
             FROM weeks w JOIN sc ON sc.date <= w.week_end)
    , m AS (
        SELECT COALESCE(a.week_index, b.week_index) AS week_index, COALESCE(a.id, b.id) AS id,
               COALESCE(a.itemid, b.itemid) AS itemid,
               (a.id IS NULL OR (b.id IS NOT NULL AND a.base_cost = 0)) AS use_sc,
               a.date AS p_date, a.item AS p_item, a.base_uofm AS p_uofm, a.base_cost AS p_cost,
               b.date AS s_date, b.item AS s_item, b.base_uofm AS s_uofm, b.base_cost AS s_cost
        FROM (SELECT * FROM pw WHERE rn = 1) a
        FULL OUTER JOIN (SELECT * FROM sw WHERE rn = 1) b
          ON a.week_index = b.week_index AND a.id = b.id AND a.itemid = b.itemid)
    SELECT m.week_index, m.id AS store_id,
           CASE WHEN use_sc THEN s_item ELSE p_item END AS item, m.itemid AS item_id,
           CAST(CASE WHEN use_sc THEN s_date ELSE p_date END AS VARCHAR) AS date,
           w.year, w.period, w.week, w.period_index,
           CASE WHEN use_sc THEN s_uofm ELSE p_uofm END AS base_uofm,
           {R('CASE WHEN use_sc THEN s_cost ELSE p_cost END', 4)} AS base_cost
    FROM m JOIN weeks w ON w.week_index = m.week_index
    WHERE (CASE WHEN use_sc THEN s_uofm ELSE p_uofm END) IS NOT NULL"""


def weekly_item_base_cost(year: int, period: int, week: int) -> str:
    return _weekly(f"year = {year} AND period = {period} AND week = {week}")


def weekly_base_cost_year(years) -> str:
    return _weekly(f"year IN ({', '.join(str(y) for y in years)})")


def weekly_base_cost_by_store() -> str:
    return f"""SELECT week_index, year, period, week, store_id, count(*) AS items,
           CAST(sum(CAST(base_cost AS DECIMAL(18, 4))) AS DOUBLE) AS base_cost
    FROM ({_weekly('true')}) q GROUP BY week_index, year, period, week, store_id"""


def weekly_cost_spans() -> str:
    """Runs of weeks with the same values, from the rows of every week."""
    same = "store_id, item_id, date, item, base_uofm, base_cost"
    return f"""SELECT {same}, CAST(min(week_index) AS INTEGER) AS from_week, CAST(max(week_index) AS INTEGER) AS to_week
    FROM (SELECT *, week_index - row_number() OVER (PARTITION BY {same} ORDER BY week_index) AS island
          FROM ({_weekly('true')}) q) r GROUP BY {same}, island"""
