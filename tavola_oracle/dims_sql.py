"""Oracle SQL for calendar, budget, business-day and text queries."""

from __future__ import annotations

from tavola_oracle.mart_sql import R

CAL = """
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (SELECT CAST(d AS DATE) AS date FROM span, generate_series(lo, hi, INTERVAL 1 DAY) AS g(d)),
nn AS (SELECT date, datediff('day', DATE '1995-01-01', date) AS n FROM days),
cal AS (
  SELECT date, CAST(n % 7 + 1 AS INTEGER) AS dow, CAST((n % 28) // 7 + 1 AS INTEGER) AS week,
         CAST((n % 364) // 28 + 1 AS INTEGER) AS period,
         CAST(least(((n % 364) // 28) // 3 + 1, 4) AS INTEGER) AS quarter,
         CAST(1995 + n // 364 AS INTEGER) AS year, CAST(n // 7 AS INTEGER) AS week_index,
         CAST(n // 28 AS INTEGER) AS period_index,
         CAST(date - CAST(n % 7 AS INTEGER) AS DATE) AS week_start,
         CAST(date + CAST(6 - n % 7 AS INTEGER) AS DATE) AS week_end,
         CAST(date - CAST(n % 28 AS INTEGER) AS DATE) AS period_start,
         CAST(date - CAST(n % 28 AS INTEGER) + 27 AS DATE) AS period_end,
         CAST(date - CAST(n % 364 AS INTEGER) AS DATE) AS year_start
  FROM nn),
cal2 AS (
  SELECT *, CAST(year_start + (quarter - 1) * 84 AS DATE) AS quarter_start,
         CAST(CASE WHEN quarter < 4 THEN year_start + quarter * 84 - 1 ELSE year_start + 363 END AS DATE)
           AS quarter_end,
         CAST(year_start + 363 AS DATE) AS year_end
  FROM cal)
"""
DATE_COLS = ["date", "week_start", "week_end", "period_start", "period_end", "quarter_start",
             "quarter_end", "year_start", "year_end"]
INT_COLS = ["dow", "week", "period", "quarter", "year", "week_index", "period_index"]


def fiscal_calendar() -> str:
    return CAL + "SELECT " + ", ".join([f"CAST({c} AS VARCHAR) AS {c}" for c in DATE_COLS] + INT_COLS) \
        + " FROM cal2"


def calendar_rollforward() -> str:
    cols = [f"strftime({c} + 364, '%m/%d/%y') AS {c}" for c in DATE_COLS] + \
           [c if c != "year" else "year + 1 AS year" for c in INT_COLS]
    return CAL + "SELECT " + ", ".join(cols) + " FROM cal2"


def fiscal_range() -> str:
    return CAL + """SELECT year, period, CAST(min(date) AS VARCHAR) AS start_date,
                           CAST(max(date) AS VARCHAR) AS end_date FROM cal2 GROUP BY 1, 2"""


def business_date_0400() -> str:
    return f"""
    SELECT CAST(CAST(timezone('America/New_York', ts AT TIME ZONE 'UTC') - INTERVAL 4 HOUR AS DATE)
                AS VARCHAR) AS business_date,
           event_type, count(*) AS events, {R('sum(value)', 2)} AS value
    FROM events GROUP BY 1, 2"""


def budget_unpivot() -> str:
    return f"""
    WITH rows AS (
      SELECT n_name AS name,
             '4' || substr(o_orderpriority, 1, 1) || '00 - Sales ' || substr(o_orderpriority, 3, 100)
               AS account, year(o_orderdate) AS year, month(o_orderdate) AS month, o_totalprice
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
    sums AS (SELECT name, account, year, month, sum(o_totalprice) AS amount FROM rows GROUP BY 1, 2, 3, 4),
    groups AS (SELECT DISTINCT name, account, year FROM rows),
    grid AS (SELECT g.*, p.period FROM groups g, generate_series(1, 13) AS p(period))
    SELECT grid.name AS location, split_part(grid.account, ' - ', 1) AS gl_number,
           split_part(grid.account, ' - ', 2) AS account_name, grid.year,
           CAST(grid.period AS INTEGER) AS period, {R('COALESCE(s.amount, 0.0)', 2)} AS amount
    FROM grid LEFT JOIN sums s ON s.name = grid.name AND s.account = grid.account
                              AND s.year = grid.year AND s.month = grid.period"""


def budget_long() -> str:
    long = budget_unpivot().split("SELECT grid.name AS location", 1)[0]
    return long + f"""SELECT grid.name, grid.account AS "Account", grid.year, 'Period ' || lpad(CAST(grid.period AS VARCHAR), 2, '0') AS period_name,
           CASE WHEN grid.period = 13 THEN 0.0 ELSE {R('s.amount', 2)} END AS amount
    FROM grid LEFT JOIN sums s ON s.name = grid.name AND s.account = grid.account AND s.year = grid.year AND s.month = grid.period"""


def item_name_parts() -> str:
    full = "(p_brand || ' - ' || p_type || ' - ' || p_name)"
    cn = "(CASE WHEN p_size % 2 = 0 THEN 'Casual' ELSE 'Steakhouse' END || ' - ' || p_name)"
    mod = ("(CASE p_size % 4 WHEN 0 THEN 'Add ' WHEN 1 THEN 'Extra ' ELSE '' END || p_name || "
           "CASE WHEN p_size % 5 = 0 THEN ' Only' ELSE '' END)")
    ttl = "(lower(p_type) || '-on ' || p_name)"
    return rf"""
    SELECT p_partkey, {full} AS full_name,
           CASE WHEN strpos({full}, ' - ') > 0 THEN substr({full}, 1, strpos({full}, ' - ') - 1)
                ELSE {full} END AS first_head,
           CASE WHEN strpos({full}, ' - ') > 0 THEN substr({full}, strpos({full}, ' - ') + 3) END
             AS first_rest,
           CASE WHEN contains({full}, ' - ') THEN regexp_extract({full}, '^(.*) - (.*)$', 1)
                ELSE {full} END AS last_head,
           CASE WHEN contains({full}, ' - ') THEN regexp_extract({full}, '^(.*) - (.*)$', 2) END
             AS last_tail,
           split_part({full}, ' - ', 1) AS part0, split_part({full}, ' - ', 2) AS part1,
           string_split({full}, ' - ')[-1] AS tail,
           regexp_replace({full}, '^(?:.*?( -)){{2}}', '-') AS collapsed,
           trim(regexp_replace({cn}, '^(?:Casual|Steakhouse)\s*-\s*', '')) AS no_concept,
           array_to_string(list_transform(string_split({ttl}, '-'),
               lambda x: array_to_string(list_transform(string_split(x, ' '),
                    lambda w: upper(w[1]) || lower(w[2:])), ' ')), '-') AS titled,
           regexp_replace(regexp_replace({mod}, '^(Add|Extra|Lite|On Side)\s+', ''),
                          '\s+(On Side|Only)$', '') AS unmodified
    FROM part"""


def invoice_money_text() -> str:
    return """
    SELECT l_orderkey, l_linenumber, l_partkey, t AS amount_text,
           CAST(replace(regexp_replace(t, '^\\((.*)\\)$', '-\\1'), ',', '') AS DOUBLE) AS amount,
           regexp_matches(t, '^\\((.+)\\)') AS is_return
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN '(' || format('{:,.2f}', l_extendedprice) || ')'
                         ELSE format('{:,.2f}', l_extendedprice) END AS t FROM lineitem)"""
