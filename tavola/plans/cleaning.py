"""Column work on landed reports (PRJ-01 .. PRJ-11, AGG-04/05, JN-16, DT-01/02/07/11, RSH-02, STR-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.dates import business_day_bounds, day_of, parse_ts, reformat_date
from tavola.functions.numeric import nan_to_null
from tavola.functions.strings import fold_accents, path_join, replace_literals
from tavola.functions.util import as_col
from tavola.operators.aggregates import conditional_sum, mean_numeric, sum_numeric
from tavola.operators.calendar import calendar_weeks, date_series, fiscal_of, prior_week_end
from tavola.operators.filters import range_filter
from tavola.operators.joins import coalesce_cols, join_checked
from tavola.operators.reshape import (cast_to, densify, drop_strict, fill, lower_names, project, rename, replace_values, unpivot,
                                      update_where)
from tavola.plans.dims import budget_wide
from tavola.plans.pos import payment_report
from tavola.sources.mart import FISCAL_EPOCH, TIMEZONE, Mart


def received_lines(mart: Mart) -> DataFrame:
    """PRJ-01/02/03/05/06/07/11: a receiving report brought into the table's shape.

    The report has spare text boxes, column names in two spellings, quantities as
    text and one-letter accounts."""
    li = mart.raw("lineitem")
    report = li.select(
        F.col("l_orderkey").alias("transaction_ID"), F.col("l_linenumber").alias("LineNumber"), F.col("l_returnflag").alias("Account"),
        F.when(F.col("l_quantity") % 10 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("Quantity"),
        F.col("l_extendedprice").alias("ExtPrice2"), F.lit("x").alias("Textbox3"))
    rows = rename(drop_strict(report, "Textbox3"), {"Transaction_Id": "transactionid", "extprice2": "amount"})
    rows = cast_to(lower_names(rows), {"quantity": "double"})
    rows = replace_values(fill(rows, {"quantity": 0.0}), "account", {"R": "Beer", "A": "Liquor", "N": "Wine"})
    rows = update_where(rows, F.col("quantity") > 45, {"account": F.concat("account", F.lit(" bulk")), "quantity": F.lit(45.0)})
    out = project(rows, ["transactionid", "linenumber", "account", "quantity", "amount", "note"])
    return out.withColumn("note", F.col("note").cast("string"))


def _event_measures(mart: Mart) -> DataFrame:
    """Values and tips per store; the value of every eleventh user is NaN as a broken export writes it."""
    value = F.when(F.col("user_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    e = mart.raw("events").select((F.col("user_id") % 20).alias("store_id"), "event_type",
                                  F.round(nan_to_null(value), 2).alias("value"),
                                  F.when(F.col("event_type") == "purchase", F.round(F.col("value") * 0.15, 2)).alias("tip"))
    return e


def store_sums(mart: Mart) -> DataFrame:
    """AGG-04: every measure summed per store and kind of event."""
    out = sum_numeric(_event_measures(mart), ["store_id", "event_type"])
    return out.select("store_id", "event_type", F.round("value", 2).alias("value"), F.round("tip", 2).alias("tip"))


def store_means(mart: Mart) -> DataFrame:
    """AGG-05: every measure averaged per store and kind of event."""
    out = mean_numeric(_event_measures(mart), ["store_id", "event_type"])
    return out.select("store_id", "event_type", F.round("value", 6).alias("value"), F.round("tip", 6).alias("tip"))


def orders_with_customer(mart: Mart) -> DataFrame:
    """JN-16: orders of half a year with their customer; the customers' own ``comment`` gets a suffix."""
    o = mart.raw("orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("date"),
                                  F.col("o_orderpriority").alias("label"))
    c = mart.raw("customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("label"), "c_nationkey")
    return join_checked(range_filter(o, "date", "1999-01-01", "1999-07-01"), c, ["custkey"], suffix="_customer")


def order_weeks(mart: Mart) -> DataFrame:
    """DT-11: orders per day with the last day of the fiscal week before it (days of
    the first week have none and are left out)."""
    days = mart.raw("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders"))
    cal = calendar_weeks(mart.raw("orders"), "o_orderdate", FISCAL_EPOCH)
    return prior_week_end(cal, days).filter("prior_week_end IS NOT NULL").select("date", "orders", "week_index", "prior_week_end", "prior_year", "prior_period", "prior_week")


def business_days(mart: Mart) -> DataFrame:
    """DT-07: start and end of every business day as ISO text with the offset of the store's zone."""
    days = mart.raw("orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    start, end = business_day_bounds("date", TIMEZONE)
    return days.select("date", start.alias("start_date"), end.alias("end_date"))


def payment_rows(mart: Mart) -> DataFrame:
    """DOM-12 / DT-01/02/04: the payment report itself, times parsed and the day as the report writes it."""
    r = payment_report(mart)
    paid = parse_ts("paidDate", "yyyy-MM-dd'T'HH:mm:ss")
    day = day_of(paid)
    return r.select("guid", "type", "cardEntryMode", "amount", "tipAmount", paid.alias("paid_at"), day.alias("paid_on"),
                    reformat_date(F.date_format(day, "yyyyMMdd"), "yyyyMMdd", "MM/dd/yy").alias("day_text"), "location_name",
                    F.col("`server.guid`").alias("server_guid"), F.col("`lastModifiedDevice.id`").alias("device_id"))


def budget_long(mart: Mart) -> DataFrame:
    """RSH-02: the budget unpivoted over all columns but the ids."""
    long = unpivot(budget_wide(mart), ["name", "Account", "year"], None, "period_name", "amount")
    return long.withColumn("amount", F.round("amount", 2))


def item_labels(mart: Mart) -> DataFrame:
    """STR-05 / STR-13: accents folded, spellings fixed, category paths without gaps."""
    name = F.concat(F.col("p_name"), F.when(F.col("p_size") % 3 == 0, F.lit(" Crème Brûlée")).when(F.col("p_size") % 3 == 1, F.lit(" Jalapeno's")).otherwise(""))
    fixed = replace_literals(name, {"Jalapeno's": "Jalapenos", "Brûlée": "Brulée"})
    return mart.raw("part").select(F.col("p_partkey").alias("itemid"), fold_accents(fixed).alias("label"),
                                   path_join(" > ", "p_brand", F.when(F.col("p_size") % 4 != 0, as_col("p_type")), "p_name").alias("path"))


def fiscal_totals(mart: Mart) -> DataFrame:
    """DT-09 / AGG-07: order totals per fiscal week, those of closed and of open orders apart."""
    cal = calendar_weeks(mart.raw("orders"), "o_orderdate", FISCAL_EPOCH)
    o = fiscal_of(mart.raw("orders").select("o_orderdate", "o_orderstatus", F.col("o_totalprice").cast("decimal(20,2)").alias("total")), "o_orderdate", cal)
    sums = [conditional_sum("total", F.col("o_orderstatus") == s).cast("double").alias(n) for s, n in (("F", "closed"), ("O", "open"))]
    return o.groupBy("year", "period", "week").agg(F.count("*").alias("orders"), *sums)


def store_days(mart: Mart, start: str = "2000-01-01", end: str = "2000-01-14") -> DataFrame:
    """RSH-04 / DT-06 / PRJ-09: every store on every day of a fortnight with the lines it counted or bought, 0 without any."""
    grid = densify(mart.restaurants.select("id", F.col("name").alias("name_x")), start, end)
    days = date_series(mart.spark, start, end)
    lines = mart.detail_rows().join(F.broadcast(days), "date").groupBy("id", "date").agg(F.count("*").alias("n"), F.first("store").alias("name_y"))
    return grid.join(lines, ["id", "date"], "left").select("id", "date", coalesce_cols("name_y", "name_x").alias("name"), F.coalesce("n", F.lit(0)).alias("lines"))
