"""Oracle SQL for the table-maintenance queries."""

from __future__ import annotations

FEED = {
    "feed": """SELECT o_orderkey AS salesdetailid, o_orderpriority AS location,
                      CAST(o_orderdate AS DATE) AS date, o_custkey AS customer,
                      o_totalprice AS amount FROM orders""",
    "target": """SELECT *, CASE WHEN customer % 50 <> 0 THEN 'v1' END AS version,
                        DATE '2000-01-01' AS last_update
                 FROM feed WHERE date < DATE '2000-01-01'""",
    "batch": """SELECT * REPLACE (CAST(round(CAST(CAST(amount * 1.1 AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), 2)
                                   AS DOUBLE) AS amount),
                       'v' || CAST(salesdetailid % 2 + 1 AS VARCHAR) AS version
                FROM feed WHERE date >= DATE '1999-07-01'""",
}

COLS = "salesdetailid, location, CAST(date AS VARCHAR) AS date, customer, amount, version, " \
       "CAST(last_update AS VARCHAR) AS last_update"


def _with(body: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in FEED.items()) + "\n" + body


def upsert_full() -> str:
    return _with(f"""
    SELECT {COLS} FROM (
      SELECT * FROM target WHERE salesdetailid NOT IN (SELECT salesdetailid FROM batch)
      UNION ALL SELECT *, NULL::DATE AS last_update FROM batch)""")


def upsert_subset() -> str:
    return _with(f"""
    SELECT {COLS} FROM (
      SELECT COALESCE(t.salesdetailid, b.salesdetailid) AS salesdetailid,
             CASE WHEN t.salesdetailid IS NOT NULL THEN t.location ELSE b.location END AS location,
             CASE WHEN t.salesdetailid IS NOT NULL THEN t.date ELSE b.date END AS date,
             CASE WHEN t.salesdetailid IS NOT NULL THEN t.customer ELSE b.customer END AS customer,
             CASE WHEN b.salesdetailid IS NOT NULL THEN b.amount ELSE t.amount END AS amount,
             CASE WHEN b.salesdetailid IS NOT NULL THEN b.version ELSE t.version END AS version,
             CASE WHEN b.salesdetailid IS NOT NULL THEN DATE '2001-08-01' ELSE t.last_update END
               AS last_update
      FROM target t FULL OUTER JOIN batch b ON b.salesdetailid = t.salesdetailid)""")


def replace_keys() -> str:
    return _with(f"""
    SELECT {COLS} FROM (
      SELECT * FROM target WHERE date NOT IN (SELECT date FROM batch)
      UNION ALL SELECT *, NULL::DATE AS last_update FROM batch)""")


def drop_superseded_any() -> str:
    return _with(f"""
    SELECT {COLS} FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.location = t.location AND b.date = t.date
                      AND b.version <> t.version)""")


def drop_superseded_absent() -> str:
    return _with(f"""
    SELECT {COLS} FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.location = t.location AND b.date = t.date)
       OR EXISTS (SELECT 1 FROM batch b WHERE b.location = t.location AND b.date = t.date
                  AND b.version = t.version)""")


def replace_range() -> str:
    return _with(f"""
    SELECT {COLS} FROM (
      SELECT * FROM target WHERE NOT (date >= DATE '1999-07-01' AND date < DATE '2000-01-01')
      UNION ALL
      SELECT *, NULL::DATE AS last_update FROM batch
      WHERE date >= DATE '1999-07-01' AND date < DATE '2000-01-01')""")


def replace_year() -> str:
    return _with(f"""
    SELECT {COLS} FROM (
      SELECT * FROM target WHERE year(date) NOT IN (SELECT DISTINCT year(date) FROM batch)
      UNION ALL SELECT *, NULL::DATE AS last_update FROM batch)""")


def sync_full() -> str:
    return _with(f"""
    SELECT {COLS} FROM (
      SELECT b.*, t.last_update FROM batch b LEFT JOIN target t ON t.salesdetailid = b.salesdetailid)""")


SNAP = {
    "old": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "new": """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name || ' (closed)' ELSE c_name END AS c_name,
                     c_acctbal FROM customer""",
    "ren": """SELECT o.c_custkey, o.c_name AS old_c_name, n.c_name AS new_c_name
              FROM old o JOIN new n ON n.c_custkey = o.c_custkey
              WHERE o.c_name IS DISTINCT FROM n.c_name""",
}


def renamed_customers() -> str:
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in SNAP.items()) + " SELECT * FROM ren"


def orders_with_renames() -> str:
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in SNAP.items()) + """
    SELECT o.o_custkey, o.o_orderkey, COALESCE(r.new_c_name, c.c_name) AS cust_name
    FROM orders o JOIN old c ON c.c_custkey = o.o_custkey
    LEFT JOIN (SELECT DISTINCT old_c_name, new_c_name FROM ren) r ON r.old_c_name = c.c_name"""


def events_dedup(keep: str) -> str:
    d = "DESC" if keep == "last" else "ASC"
    return f"""
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {d}, event_id {d}) AS rn
      FROM events) WHERE rn = 1"""


def orders_fk_validated() -> str:
    return """
    SELECT o_orderkey,
           CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
                THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
           o_totalprice
    FROM orders"""


def lineitem_duplicates() -> str:
    return """
    SELECT l.l_orderkey, l.l_linenumber, l_partkey, l_suppkey, l_quantity, d.copies
    FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
                          GROUP BY 1, 2 HAVING count(*) > 1) d
      ON d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber"""
