"""Calendar, budget and business-day jobs (DOM-16, DOM-17, DT-07, DT-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.dates import business_date
from tavola.functions.strings import extract_int, split_parts
from tavola.operators.calendar import calendar_as_text, calendar_for, roll_calendar
from tavola.operators.reshape import unpivot
from tavola.sources.mart import FISCAL_EPOCH, TIMEZONE, Mart

BUSINESS_DAY_START = 4


def fiscal_calendar_of_orders(mart: Mart) -> DataFrame:
    """DT-06/DT-12: the fiscal calendar over the span of the order dates."""
    return calendar_for(mart.raw("orders"), "o_orderdate", FISCAL_EPOCH)


def calendar_rollforward(mart: Mart) -> DataFrame:
    """DOM-17 / DT-03: next year's calendar from this one, in its CSV text
    form (year + 1, every date + 364 days)."""
    return roll_calendar(calendar_as_text(fiscal_calendar_of_orders(mart)))


def fiscal_ranges(mart: Mart) -> DataFrame:
    """DT-10: first and last day of every fiscal period in the span."""
    return (fiscal_calendar_of_orders(mart).groupBy("year", "period")
            .agg(F.min("date").alias("start_date"), F.max("date").alias("end_date")))


def business_day_sales(mart: Mart, tz: str = TIMEZONE, start_hour: int = BUSINESS_DAY_START) -> DataFrame:
    """DT-07: events per local business day (the day starts at 04:00)."""
    ev = mart.raw("events")
    return (ev.withColumn("business_date", business_date("ts", tz, start_hour))
              .groupBy("business_date", "event_type")
              .agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value")))


PERIODS = [f"Period {i:02d}" for i in range(1, 14)]


def budget_wide(mart: Mart) -> DataFrame:
    """The budget workbook shape: one row per (location, account, year) and
    one column per fiscal period (order totals by month; period 13 is 0)."""
    o = mart.raw("orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = mart.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = mart.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"))
    rows = (o.join(c, "o_custkey").join(n, "c_nationkey")
             .select("name",
                     F.concat(F.lit("4"), F.substring("o_orderpriority", 1, 1), F.lit("00 - Sales "),
                              F.substring("o_orderpriority", 3, 100)).alias("Account"),
                     F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                     "o_totalprice"))
    wide = rows.groupBy("name", "Account", "year").pivot("month", list(range(1, 13))) \
               .agg(F.sum("o_totalprice"))
    return wide.select("name", "Account", "year",
                       *[F.col(str(i)).alias(PERIODS[i - 1]) for i in range(1, 13)],
                       F.lit(0.0).alias(PERIODS[12]))


def budget_unpivot(mart: Mart) -> DataFrame:
    """DOM-16 / RSH-01 / STR-02 / STR-08: the wide budget to one row per
    (location, GL number, account, year, period); missing amounts are 0."""
    long = unpivot(budget_wide(mart), ["name", "Account", "year"], PERIODS, "period_name", "amount")
    gl_number, account_name = split_parts("Account", 2)
    return long.select(F.col("name").alias("location"), gl_number.alias("gl_number"),
                       account_name.alias("account_name"), "year",
                       extract_int("period_name").alias("period"),
                       F.round(F.coalesce(F.col("amount"), F.lit(0.0)), 2).alias("amount"))
