"""Reports and dimension jobs: receiving, category margins, recipe cost, menu items,
unmapped items, item conversion, holidays (DOM-09, 13, 14, 15, 18, 21, 24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.dates import parse_date
from tavola.functions.strings import parse_money, split_first, strip, title_case
from tavola.functions.util import case_map
from tavola.operators import merge
from tavola.operators.aggregates import pivot_margins, with_totals
from tavola.operators.filters import affix_filter, all_null, drop_returns
from tavola.operators.windows import dedup, first_in_group
from tavola.plans.recipes import PREP_PREFIX, recipe_edges
from tavola.session import written
from tavola.sources.mart import CONCEPTS, GL_ACCOUNTS, MENU_CATEGORY1, MENU_CATEGORY2, Mart

# Sort order of the menu's second category; any other is last.
CATEGORY_SORT = {"Appetizer": 1, "Salad": 2, "Sandwich": 3, "Entree": 4, "Side": 5, "Dessert": 6, "Early Evening": 7,
                 "Brunch": 8, "Kid Meal": 9, "Add-On": 10, "Beverage": 11, "Special": 12, "Catering": 13, "No Charge": 14,
                 "Beer": 15, "Wine": 16, "Liquor": 17, "None": 18}
# Beginnings and ends of names that are notes to the kitchen, not items.
NOTE_PREFIXES = ("No ", "Seat ", "& ", "Splash ")
NOTE_SUFFIXES = (" Allergy", "for Salad", "for Steak", "for Sand", "for Taco", " Catering", "for Cali-Club", "for Edge")


# -- DOM-15: receiving by purchased item ---------------------------------------
def receiving_lines(mart: Mart) -> DataFrame:
    """The receiving report as landed: amounts as text with thousands commas,
    returns written in parentheses (lines at a discount of 10 % here)."""
    nation = mart.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("VendorName"))
    vendor = mart.raw("supplier").select(F.col("s_suppkey").alias("id"), "s_nationkey").join(nation, "s_nationkey")
    q = F.format_number("quantity", 2)
    return (mart.purchases.join(vendor, "id")
            .select(F.col("item").alias("ItemName"), F.col("store").alias("LocationName"), "VendorName",
                    F.col("uofm").alias("PurchaseUnit"), "date", "transactionid", "lineid",
                    F.when(F.col("discount") >= 0.1, F.concat(F.lit("("), q, F.lit(")"))).otherwise(q).alias("Quantity"),
                    F.format_number("amount", 2).alias("ExtPrice")))


def receiving_detail(mart: Mart) -> DataFrame:
    """Received lines without returns, each quantity in the unit of the item's
    first line (WIN-03); items whose first line has an unknown unit have none
    and are left out of the spend, as in the original."""
    um = mart.units.select(F.col("name").alias("PurchaseUnit"), F.col("name").alias("unit"), F.col("base_qty").alias("factor"))
    rows = (drop_returns(receiving_lines(mart), "Quantity").join(F.broadcast(um), "PurchaseUnit", "left")
            .withColumn("ExtCost", parse_money("ExtPrice")).withColumn("Quantity", parse_money("Quantity")))
    rows = written(rows.drop("ExtPrice", "PurchaseUnit"))  # read for the first lines and for all
    rows = first_in_group(rows, ["ItemName"], ["date", "transactionid", "lineid", "ExtCost", "Quantity", "LocationName"],
                          ["unit", "factor"])
    return (rows.filter(F.col("unit_first").isNotNull())
                .select("ItemName", "LocationName", "VendorName", F.col("unit_first").alias("unit"), "ExtCost",
                        F.try_divide(F.col("Quantity") * F.col("factor"), F.col("factor_first")).alias("totalQuantity")))


def receiving_spend(mart: Mart, by: str) -> DataFrame:
    """AGG-10: quantity, cost and cost per unit per item, ``by`` and unit, and
    a totals row over all."""
    rows = receiving_detail(mart).withColumn("totalQuantity", F.col("totalQuantity").cast("decimal(30,6)")) \
        .withColumn("ExtCost", F.col("ExtCost").cast("decimal(30,2)"))
    spend = rows.groupBy("ItemName", by, "unit").agg(F.coalesce(F.sum("totalQuantity"), F.lit(0)).alias("totalQuantity"),
                                                     F.sum("ExtCost").alias("ExtCost"))
    out = with_totals(spend.withColumn("_all", F.lit(1)), ["_all"], ["totalQuantity", "ExtCost"]).drop("_all")
    qty, cost = F.col("totalQuantity").cast("double"), F.col("ExtCost").cast("double")
    return out.select("ItemName", by, "unit", "row_type", F.round(qty, 4).alias("totalQuantity"), cost.alias("ExtCost"),
                      F.round(F.try_divide(cost, qty), 4).alias("CostPerUnit"))


# -- DOM-24: stock count category report ----------------------------------------
def category_report(mart: Mart, week: int, period: int, year: int, prep: bool) -> DataFrame:
    """Counted quantity and amount per store, item, account and unit of one
    fiscal week: prep items (named ``PREP ...``) or purchased items of the
    account "Food Other"."""
    made = recipe_edges(mart).select(F.col("parent").alias("itemid")).distinct().withColumn("_prep", F.lit(True))
    rows = (mart.stock_count("Stock Count").filter((F.col("week") == week) & (F.col("period") == period) & (F.col("year") == year))
            .filter(F.col("category2") == "Food Other").join(made, "itemid", "left")
            .withColumn("item", F.when(F.col("_prep"), F.concat(F.lit(PREP_PREFIX), F.col("item"))).otherwise(F.col("item"))))
    rows = rows.filter(F.col("item").like("PREP %")) if prep else rows
    return rows.groupBy("store", "item", F.col("category2").alias("account"), "uofm").agg(
        F.sum("quantity").alias("count"), F.sum(F.col("amount").cast("decimal(20,2)")).cast("double").alias("amount"))


def category_margins(mart: Mart, week: int, period: int, year: int) -> DataFrame:
    """AGG-09: amount per store with a grand total, for both sheets."""
    out = None
    for sheet, prep in (("Prep Items", True), ("Purchase Items", False)):
        rows = category_report(mart, week, period, year, prep).withColumn("amount", F.col("amount").cast("decimal(20,2)"))
        part = pivot_margins(rows, "store", "amount").select(F.lit(sheet).alias("sheet"), "store",
                                                            F.col("amount").cast("double").alias("amount"))
        out = part if out is None else out.unionByName(part)
    return out


# -- DOM-09: recipe cost snapshot -------------------------------------------------
def recipe_cost(mart: Mart, as_of: str) -> DataFrame:
    """Recipe cost per store and menu item, dated the day before ``as_of``
    (DT-08). The report names its location with padding and its item as
    "concept - item"; the store is found in two hops, name to location id to
    store (JN-06); what is missing becomes 0."""
    concept = F.when(F.col("itemid") % 2 == 0, F.lit(CONCEPTS[0])).otherwise(F.lit(CONCEPTS[1]))
    names = mart.item.select("itemid", "name")
    places = mart.restaurants.select(F.col("id").alias("store_id"), F.col("name").alias("place"))
    report = (mart.menu_cost.join(names, "itemid").join(places, "store_id")
              .select(F.concat(F.lit("  "), "place", F.lit(" ")).alias("Location"),
                      F.concat(concept, F.lit(" - "), "name").alias("MenuItemName"), F.col("cost").alias("UnitCost_Loc")))
    location = mart.restaurants.select(F.col("name").alias("location"), "locationid")
    hop = location.join(mart.restaurants.filter(F.col("pos_store_id").isNotNull()).select("locationid", "id"), "locationid")
    kind, item = split_first("MenuItemName")
    return (report.withColumn("location", strip("Location")).join(hop.select("location", "id"), "location", "left")
            .select(F.date_sub(F.to_date(F.lit(as_of)), 1).alias("date"), F.coalesce("id", F.lit(0)).alias("id"), "location",
                    kind.alias("concept"), item.alias("menu_item"),
                    F.round(F.coalesce("UnitCost_Loc", F.lit(0.0)), 4).alias("recipe_cost")))


# -- DOM-13: menu item dimension ----------------------------------------------------
def menu_item_export(mart: Mart) -> DataFrame:
    """The menu item list as exported: id, "concept - item", recipe id, categories (untidy text)."""
    p = F.col("p_partkey")
    made = recipe_edges(mart).select(F.col("parent").alias("p_partkey")).distinct().withColumn("RecipeId", p)
    concept = F.when(p % 2 == 0, F.lit(CONCEPTS[0])).otherwise(F.lit(CONCEPTS[1]))
    return (mart.raw("part").join(made, "p_partkey", "left")
            .select(p.alias("Id"), F.concat(concept, F.lit(" - "), F.col("p_name"), F.lit(" "), p.cast("string")).alias("Name"),
                    "RecipeId", case_map(F.col("p_size") % 3, MENU_CATEGORY1).alias("Category1"),
                    F.concat(F.lit(" "), F.upper(case_map(F.col("p_type"), MENU_CATEGORY2, "Other")), F.lit(" ")).alias("Category2"),
                    F.col("p_brand").alias("Category3")))


def menu_items(mart: Mart) -> DataFrame:
    """DOM-13: items with a recipe that were sold, with tidy categories, their
    sort order (PRJ-08) and a sales account (the first by name where an item
    was booked to several); one row per id."""
    export = menu_item_export(mart).filter(F.col("RecipeId").isNotNull())
    concept, item = split_first("Name")
    category = title_case(strip("Category2"))
    tidy = export.select(F.col("Id").alias("menu_item_id"), item.alias("menu_item"), concept.alias("concept"),
                         F.col("Category1").alias("category_1"), category.alias("category_2"), F.col("Category3").alias("category_3"))
    tidy = tidy.withColumn("category_2_sort", F.coalesce(case_map(F.col("category_2"), CATEGORY_SORT), F.lit(18)))
    account = {k: v for k, v in GL_ACCOUNTS}
    sold = (mart.raw("lineitem").groupBy(F.col("l_partkey").alias("itemid"))
            .agg(F.min(case_map(F.col("l_returnflag"), account)).alias("sales_account"))
            .join(mart.item.select("itemid", F.col("name").alias("menu_item")), "itemid").drop("itemid"))
    accounts = mart.glaccount.select(F.col("glaccountid").alias("sales_account_id"), F.col("name").alias("sales_account"))
    out = tidy.join(sold, "menu_item").join(F.broadcast(accounts), "sales_account", "left")
    return dedup(out, ["menu_item_id"], ["menu_item", "sales_account"], keep="first").select(
        "menu_item_id", "menu_item", "concept", "category_1", "category_2", "category_3", "sales_account_id", "category_2_sort")


# -- DOM-14: unmapped menu items ------------------------------------------------------
def daily_sales(mart: Mart) -> DataFrame:
    """NST-06 input: one row per day with nested tickets and details."""
    p = F.col("l_partkey")
    parts = mart.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size", "p_type", "p_brand")
    plain = F.concat_ws(" ", "p_name", p.cast("string"))
    # kitchen notes and concept prefixes, by rule over the key
    name = (F.when(p % 23 == 0, F.concat(F.lit("No "), plain)).when(p % 29 == 0, F.concat(plain, F.lit(" Allergy")))
             .when(p % 2 == 0, F.concat(F.lit("Casual - "), plain)).otherwise(F.concat(F.lit("Steakhouse -  "), plain)))
    mapped = (F.col("p_size") % 11) != 0
    detail = F.struct(F.when(p % 31 != 0, F.struct(p.cast("string").alias("id"), name.alias("name"))).alias("posItem"),
                      F.when(mapped, case_map(F.col("p_size") % 3, MENU_CATEGORY1)).alias("menuItemCategory1"),
                      F.when(mapped, case_map(F.col("p_type"), MENU_CATEGORY2, "Other")).alias("menuItemCategory2"),
                      F.when(mapped, F.col("p_brand")).alias("menuItemCategory3"))
    return (mart.raw("lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")
            .groupBy("l_orderkey").agg(F.collect_list(detail).alias("salesDetails"))
            .select(F.array(F.struct("salesDetails")).alias("salesTickets")))


def explode_daily_sales(days: DataFrame) -> DataFrame:
    """NST-06: tickets and details of the days, without lines that name no item."""
    ticket = days.select(F.explode("salesTickets").alias("t"))
    line = ticket.select(F.explode("t.salesDetails").alias("d")).filter(F.col("d.posItem").isNotNull())
    return line.select(F.col("d.menuItemCategory1").alias("category1"), F.col("d.menuItemCategory2").alias("category2"),
                       F.col("d.menuItemCategory3").alias("category3"), F.col("d.posItem.name").alias("name"))


def unmapped_items(mart: Mart, exclusions: DataFrame) -> DataFrame:
    """DOM-14 / DQ-07: items on the point-of-sale menu that were sold without
    any category, are no known menu item, not excluded, and no kitchen note."""
    sold = explode_daily_sales(daily_sales(mart)).distinct()
    sold = sold.withColumn("name", strip(F.regexp_replace("name", r"^(Casual|Steakhouse)\s*-\s*", ""))).distinct()
    known = menu_items(mart).filter(F.col("category_2_sort") < 18).select(F.col("menu_item").alias("name"))
    fresh = sold.join(known.distinct(), "name", "left_anti").filter(all_null(["category1", "category2", "category3"]))
    k = F.col("p_partkey")
    plain = F.concat_ws(" ", "p_name", k.cast("string"))
    menu = mart.raw("part").select(k.cast("string").alias("guid"),
                                   F.when(k % 23 == 0, F.concat(F.lit("No "), plain)).when(k % 29 == 0, F.concat(plain, F.lit(" Allergy")))
                                    .otherwise(plain).alias("name"))
    new = dedup(menu, ["name"], ["guid"], keep="first").join(fresh.select("name").distinct(), "name", "left_semi")
    new = new.join(exclusions.select(F.col(exclusions.columns[0]).alias("name")).distinct(), "name", "left_anti")
    return affix_filter(new, "name", NOTE_PREFIXES, NOTE_SUFFIXES, negate=True).select("guid", "name")


# -- DOM-21: item conversion dimension ----------------------------------------------------
CONVERSION = ["itemid", "name", "weight_qty", "volume_qty", "each_qty", "measure_type"]


def item_conversion(mart: Mart) -> DataFrame:
    """DOM-21: purchase items and recipe items as one table (SET-01), missing
    names taken from the item table (PRJ-09), nameless rows dropped, and the
    dimension synchronised to it (MRG-08)."""
    made = recipe_edges(mart).select(F.col("parent").alias("itemid")).distinct()
    listed = mart.item_conversion.select(*CONVERSION).withColumn("name", F.when(F.col("itemid") % 7 != 0, F.col("name")))
    both = listed.join(made, "itemid", "left_anti").unionByName(listed.join(made, "itemid", "left_semi"))
    names = mart.item.filter(F.col("itemid") % 35 != 0).select("itemid", F.col("name").alias("_item_name"))
    source = (both.join(names, "itemid", "left").withColumn("name", F.coalesce("name", "_item_name")).drop("_item_name")
              .filter(F.col("name").isNotNull()))
    # the table as it was: every other item, with old quantities, and items that are gone
    before = (mart.item_conversion.select(*CONVERSION).filter(F.col("itemid") % 2 == 0)
              .withColumn("weight_qty", F.lit(0.0))
              .unionByName(mart.item_conversion.select(*CONVERSION).filter(F.col("itemid") % 10 == 0)
                           .withColumn("itemid", -F.col("itemid") - 1)))
    return merge.sync(before, merge.prepare_batch(source, ["itemid"]), ["itemid"])


# -- DOM-18: holidays --------------------------------------------------------------------
def holiday_file(mart: Mart) -> DataFrame:
    """The holiday list as landed: text dates, some of them no date."""
    day = F.to_date("o_orderdate")
    first = (mart.raw("orders").groupBy(F.year(day).alias("y"), F.month(day).alias("m")).agg(F.min(day).alias("d"))
             .filter("y >= 1998"))
    return first.select((F.col("y") * 100 + F.col("m")).alias("holiday_key"), F.concat(F.lit("Day "), F.col("m").cast("string")).alias("holiday_name"),
                        F.when(F.col("m") == 2, F.lit("soon")).otherwise(F.date_format("d", "MM/dd/yyyy")).alias("holiday_date"),
                        (F.col("m") % 3).alias("holiday_offset"))


def holidays(mart: Mart) -> DataFrame:
    """DOM-18: the years in the file replace the same years of the table
    (MRG-07); a date that cannot be read stays null and replaces nothing."""
    batch = holiday_file(mart).withColumn("holiday_date", parse_date("holiday_date", "MM/dd/yyyy"))
    day = F.to_date("o_orderdate")
    table = (mart.raw("orders").groupBy(F.year(day).alias("y")).agg(F.max(day).alias("holiday_date"))
             .select((-F.col("y")).alias("holiday_key"), F.lit("Old day").alias("holiday_name"), "holiday_date",
                     F.lit(0).alias("holiday_offset")))
    return merge.replace_partitions(table, batch, F.year("holiday_date"))
