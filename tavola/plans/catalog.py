"""Named queries over the mart: name -> callable(spark, sf_dir) -> DataFrame.

These are the jobs and views a user of the mart runs, each over the whole
input tables. ``AS_OF`` fixes the reference day of the rolling-window views so
that results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.plans import views
from tavola.sources.mart import Mart

AS_OF = "2001-08-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def stable(df: DataFrame) -> DataFrame:
    """Date and timestamp columns as ISO text, so that every client (Arrow,
    collect, another engine) sees the same values."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str):
    def deco(fn: Callable[[Mart], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: stable(fn(Mart(spark, sf_dir)))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# -- views ------------------------------------------------------------------
@query("current_base_cost_first")
def _cbc_first(m: Mart) -> DataFrame:
    """VW-01 with the original's pick (oldest invoice), Beer."""
    return views.current_base_cost(m, "Beer", "first")


@query("current_base_cost_last")
def _cbc_last(m: Mart) -> DataFrame:
    """VW-01 with the newest invoice, Liquor."""
    return views.current_base_cost(m, "Liquor", "last")


@query("current_base_cost_wine")
def _cbc_wine(m: Mart) -> DataFrame:
    return views.current_base_cost(m, "Wine", "first")


@query("stock_category_totals")
def _sct(m: Mart) -> DataFrame:
    return views.stockcount_category_totals(m)


@query("stock_conversion")
def _sconv(m: Mart) -> DataFrame:
    return views.stockcount_conversion(m, AS_OF)


@query("stock_monthly_densified")
def _smon(m: Mart) -> DataFrame:
    return views.stockcount_monthly(m, AS_OF)


@query("stock_purchases")
def _spur(m: Mart) -> DataFrame:
    return views.stockcount_purchases(m, AS_OF)


@query("stock_waste")
def _swaste(m: Mart) -> DataFrame:
    return views.stockcount_waste(m)


@query("stock_waste_fanout")
def _swaste_fan(m: Mart) -> DataFrame:
    return views.stockcount_waste(m, fanout=True)


# -- theoretical usage --------------------------------------------------------
from tavola.plans import sales  # noqa: E402


@query("theoretical_usage")
def _use(m: Mart) -> DataFrame:
    """VW-06 / REC-05 / JN-07 / JN-08 / FLT-08: ingredients used by the sales of a month."""
    return sales.stockcount_sales(m, AS_OF)


@query("theoretical_usage_single_concept")
def _use1(m: Mart) -> DataFrame:
    """VW-07 / JN-15: the same with one concept per menu item."""
    return sales.stockcount_sales_single_concept(m, AS_OF)


# -- cost jobs ----------------------------------------------------------------
from tavola.plans import cost  # noqa: E402

COST_WEEK = (2000, 6, 2)      # fiscal year, period, week of the one-week job
COST_YEARS = (2000,)          # years of the detailed backfill


@query("latest_item_price")
def _lip(m: Mart) -> DataFrame:
    """DOM-05 / WIN-01: newest purchase per store and item."""
    return cost.latest_item_price(m)


@query("weekly_item_base_cost")
def _wibc(m: Mart) -> DataFrame:
    """DOM-06 / JN-13 / JN-19: one fiscal week."""
    return cost.weekly_item_base_cost(m, *COST_WEEK)


@query("weekly_base_cost_year")
def _wbcy(m: Mart) -> DataFrame:
    """DOM-06 / JN-14: every week of the given years, per store and item."""
    return cost.weekly_base_cost_all(m, COST_YEARS)


@query("weekly_base_cost_all")
def _wbca(m: Mart) -> DataFrame:
    """DOM-06 / JN-14: item costs of every fiscal week of the data; a row stands for the
    weeks from_week to to_week."""
    return cost.weekly_cost_spans(m)


@query("weekly_base_cost_by_store")
def _wbcs(m: Mart) -> DataFrame:
    """DOM-06: every fiscal week of the data, summarised per store."""
    return cost.weekly_base_cost_by_store(m)


@query("weekly_cost_increment")
def _wci(m: Mart) -> DataFrame:
    """INC-03: the same spans, reached by applying a late batch to the touched keys only."""
    return cost.weekly_cost_increment(m)


# -- menu engineering ----------------------------------------------------------
from tavola.plans import menu  # noqa: E402

MENU_DATE, MENU_YEAR, MENU_PERIOD = AS_OF, 2001, 8


@query("menu_engineering")
def _me(m: Mart) -> DataFrame:
    """DOM-01 + DOM-03: metrics per store and item with bread-basket rows."""
    return menu.menu_engineering(m, MENU_DATE, MENU_YEAR, MENU_PERIOD)


@query("menu_rating")
def _mr(m: Mart) -> DataFrame:
    """DOM-02: Star / Opportunity / Puzzle / Dog per store and category."""
    return menu.menu_rating(m, menu.specialty_items(m))


@query("menu_rating_totals")
def _mrt(m: Mart) -> DataFrame:
    """DOM-02 + AGG-08: rated detail plus a totals row per store/category."""
    return menu.menu_rating_totals(m, menu.specialty_items(m))


@query("uncategorised_top25")
def _unc(m: Mart) -> DataFrame:
    """DOM-04 / DQ-06 / SRT-03: uncategorised items, top 25 by sales."""
    return menu.uncategorised_items(m, menu.specialty_items(m), "sales", 25)


# -- recipes ------------------------------------------------------------------
from tavola.plans import recipes  # noqa: E402


@query("recipe_explosion")
def _rex(m: Mart) -> DataFrame:
    """REC-01/02 / DOM-08: menu items exploded into raw ingredients."""
    return recipes.recipe_explosion(m)


@query("menu_item_recipes")
def _mir(m: Mart) -> DataFrame:
    """DOM-08 bridge table."""
    return recipes.menu_item_recipes(m)


@query("recipe_base_units")
def _rbu(m: Mart) -> DataFrame:
    """DOM-07 / NUM-09: direct menu-recipe ingredients in base units."""
    return recipes.recipe_base_units(m)


@query("menu_cost_converted")
def _mcc(m: Mart) -> DataFrame:
    """DOM-10 / NUM-07: ingredient cost with unit conversion."""
    return recipes.menu_cost_converted(m)


# -- table maintenance ---------------------------------------------------------
from tavola.plans import maintenance as mt  # noqa: E402

for _name, _fn, _doc in [
    ("upsert_full", mt.upsert_full, "MRG-01/02: whole-row upsert on the key."),
    ("upsert_subset", mt.upsert_subset, "MRG-01/10: subset-column upsert with update stamp."),
    ("replace_keys", mt.replace_keys, "MRG-03: delete the batch's days, insert the batch."),
    ("drop_superseded_any", mt.drop_superseded_any, "MRG-04: delete rows of another version."),
    ("drop_superseded_absent", mt.drop_superseded_absent, "MRG-05: delete rows whose version is gone."),
    ("replace_range", mt.replace_range, "MRG-06/11: replace a half-open date range."),
    ("replace_year", mt.replace_year, "MRG-07: replace the years present in the batch."),
    ("sync_full", mt.sync_full, "MRG-08: full sync to the batch."),
    ("find_renamed", mt.renamed_customers, "JN-18: renamed customers between snapshots."),
    ("apply_renames", mt.orders_with_renames, "MRG-09: rename propagation into a fact."),
    ("dedup_keep_last", lambda m: mt.events_dedup(m, "last"), "AGG-13: last event per user."),
    ("dedup_keep_first", lambda m: mt.events_dedup(m, "first"), "AGG-13: first event per user."),
    ("fk_validate", mt.orders_fk_validated, "JN-17: null out unknown customer ids."),
    ("duplicate_report", mt.lineitem_duplicates, "DQ-03: repeated (order, line) keys."),
]:
    query(_name)(_fn)
    QUERIES[_name].__doc__ = _doc


# -- calendar, budgets, business days, text ------------------------------------
from tavola.plans import dims, text  # noqa: E402

for _name, _fn, _doc in [
    ("fiscal_calendar", dims.fiscal_calendar_of_orders, "DT-06/DT-12: fiscal calendar of the order span."),
    ("calendar_rollforward", dims.calendar_rollforward, "DOM-17 / DT-03: next year's calendar."),
    ("fiscal_range", dims.fiscal_ranges, "DT-10: start and end of every fiscal period."),
    ("business_date_0400", dims.business_day_sales, "DT-07: events per 04:00 business day."),
    ("budget_unpivot", dims.budget_unpivot, "DOM-16 / RSH-01 / STR-08: budgets to long form."),
    ("item_name_parts", text.item_name_parts, "STR-01..07, STR-12: name splitting and clean-up."),
    ("paren_negative", text.invoice_money_text, "STR-09/10 + FLT-10: report money text parsed."),
]:
    query(_name)(_fn)
    QUERIES[_name].__doc__ = _doc


# -- point of sale (nested JSON) --------------------------------------------------
from tavola.plans import pos  # noqa: E402


@query("payment_summary")
def _pay(m: Mart) -> DataFrame:
    """DOM-12 / NST-02 / FLT-03 / AGG-03: credit payments by entry mode."""
    return pos.payment_summary(m)


@query("product_mix_nested")
def _pmix(m: Mart) -> DataFrame:
    """DOM-11 / NST-03..05 / REC-03 / AGG-15/16: product mix from orders."""
    return pos.product_mix(m)


# -- reports and dimension jobs --------------------------------------------------
from tavola.plans import reports  # noqa: E402

for _name, _fn, _doc in [
    ("receiving_vendor", lambda m: reports.receiving_spend(m, "VendorName"), "DOM-15 / AGG-10: spend by vendor."),
    ("receiving_location", lambda m: reports.receiving_spend(m, "LocationName"), "DOM-15 / AGG-10: spend by store."),
    ("stock_category_margins", lambda m: reports.category_margins(m, 2, 6, 2000), "DOM-24 / AGG-09: sheets with a margin row."),
    ("recipe_cost_snapshot", lambda m: reports.recipe_cost(m, AS_OF), "DOM-09 / JN-06 / DT-08: recipe cost per store."),
    ("menu_items", reports.menu_items, "DOM-13 / PRJ-08: menu item dimension."),
    ("unmapped_items", lambda m: reports.unmapped_items(m, menu.specialty_items(m)), "DOM-14 / DQ-07: items without a category."),
    ("item_conversion_sync", reports.item_conversion, "DOM-21: conversion dimension, synchronised."),
    ("holidays", reports.holidays, "DOM-18: holidays replaced by year."),
]:
    query(_name)(_fn)


# -- feeds and dimension loads ----------------------------------------------------
from tavola.plans import feeds  # noqa: E402

for _name, _fn in [
    ("feed_transaction", feeds.transaction_feed), ("feed_transaction_detail", feeds.transaction_detail_feed),
    ("feed_labor_detail", feeds.labor_detail_feed), ("feed_sales_detail", feeds.sales_detail_feed),
    ("feed_sales_employee", feeds.sales_employee_feed), ("feed_sales_payment", feeds.sales_payment_feed),
    ("dss_list", feeds.dss_list), ("dim_job_titles", feeds.job_titles), ("dim_sales_accounts", feeds.sales_accounts),
    ("dim_purchase_items", feeds.purchase_items), ("dim_units", feeds.units),
]:
    query(_name)(_fn)


# -- small record jobs -------------------------------------------------------------
from tavola.plans import records  # noqa: E402

for _name, _fn in [
    ("menu_tree", records.menu_tree), ("pos_item_dictionary", records.pos_item_dictionary),
    ("store_config", records.store_config), ("daily_sales_totals", records.daily_sales_totals),
    ("payment_ids", records.payment_ids), ("item_part_b", records.item_part_b),
]:
    query(_name)(_fn)


# -- streaming ----------------------------------------------------------------------
from tavola.plans import streams  # noqa: E402


@query("stream_sales_upsert")
def _stream(m: Mart) -> DataFrame:
    """INC-01/02: landed deliveries caught up by a stream, late corrections included."""
    return streams.sales_stream(m)


# -- checks, reports and column work --------------------------------------------------
from tavola.plans import checks, cleaning  # noqa: E402

for _name, _fn in [
    ("menu_report", lambda m: menu.menu_report(m, menu.specialty_items(m))),
    ("menu_report_by_quantity", lambda m: menu.menu_report(m, menu.specialty_items(m), "quantity")),
    ("uncategorised_top25_quantity", lambda m: menu.uncategorised_items(m, menu.specialty_items(m), "quantity", 25)),
    ("check_counts", checks.check_counts), ("quarantined_lines", checks.quarantined_lines),
    ("accepted_totals", checks.accepted_totals), ("null_lines", checks.null_lines), ("unmapped_units", checks.unmapped_units),
    ("received_lines", cleaning.received_lines), ("store_sums", cleaning.store_sums), ("store_means", cleaning.store_means),
    ("orders_with_customer", cleaning.orders_with_customer), ("order_weeks", cleaning.order_weeks),
    ("business_days", cleaning.business_days), ("payment_rows", cleaning.payment_rows), ("budget_long", cleaning.budget_long),
    ("item_labels", cleaning.item_labels), ("fiscal_totals", cleaning.fiscal_totals), ("store_days", cleaning.store_days),
]:
    query(_name)(_fn)


# -- table loads ------------------------------------------------------------------------
from tavola.plans import loads  # noqa: E402

for _name, _fn in [
    ("dim_gl_accounts", loads.gl_accounts), ("dim_locations", loads.locations), ("dim_companies", loads.companies), ("dim_items", loads.items),
    ("dim_purchase_items_all", loads.purchase_items_all), ("dim_recipes", loads.recipe_table), ("inventory_headers", loads.inventory_headers),
    ("invoice_headers", loads.invoice_headers), ("product_mix_table", loads.product_mix_table), ("menu_items_table", loads.menu_items_table),
    ("budget_table", loads.budget_table), ("weekly_cost_table", lambda m: loads.weekly_cost_table(m, *COST_WEEK)),
]:
    query(_name)(_fn)
