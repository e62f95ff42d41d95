"""Oracle SQL for the streaming catch-up."""

from __future__ import annotations

from tavola_oracle.mart_sql import R


def sales_stream() -> str:
    def sent(rows: str, summary: str, after: int, factor: float, location: str = "location") -> str:
        return f"""SELECT id, {location} AS location, date, '{summary}' AS summary, {R(f'amount * {factor}', 2)} AS amount,
                          date + {after} AS sent FROM l WHERE {rows}"""
    return f"""
    WITH l AS (SELECT o_orderkey AS id, o_custkey % 20 AS location, CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount FROM orders),
    f AS ({sent("id % 3 <> 0", "a", 1, 1.0)}
          UNION ALL {sent("day(date) % 10 = 0 AND id % 3 <> 1", "b", 40, 1.1,
                          "CASE WHEN id % 11 = 0 THEN (location + 1) % 20 ELSE location END")}
          UNION ALL {sent("day(date) % 20 = 0 AND id % 5 <> 0", "c", 400, 1.2)}),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sent DESC, summary DESC) AS rn,
                 first_value(summary) OVER (PARTITION BY location, date ORDER BY sent DESC, summary DESC) AS newest FROM f)
    SELECT id AS salesdetailid, location, CAST(date AS VARCHAR) AS date, summary AS dailysalessummaryid, amount
    FROM r WHERE rn = 1 AND summary = newest"""
