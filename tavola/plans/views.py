"""Inventory and cost views of the mart (VW-01 .. VW-08).

Each view is a function returning a DataFrame; ``register_views`` publishes
them as temp views. Presentation ``ORDER BY`` clauses of the original views
are dropped - sort at the sink if a file needs an order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.dates import since
from tavola.functions.numeric import nullif_div
from tavola.operators.windows import top_per_group
from tavola.plans import sales
from tavola.sources.mart import Mart

# Protein categories of the conversion view.
PROTEIN_CATEGORIES = ("Beef", "Pork", "Seafood")


def current_base_cost(mart: Mart, gl_name: str, pick: str = "first") -> DataFrame:
    """VW-01: per store and item, the unit and base-unit cost of one invoice
    line of the given GL account.

    ``pick='first'`` takes the *oldest* invoice (what the original view does
    despite its name); ``pick='last'`` the newest. Ties on the date are broken
    by transaction id, amount, quantity and unit so the result is
    deterministic.
    """
    td = mart.transaction_detail
    t = mart.transaction("AP Invoice")
    gl = mart.glaccount.filter(F.col("name") == gl_name).select("glaccountid")
    r = mart.restaurants.select(F.col("id").alias("store_id"), F.col("locationid"),
                                "concept", F.col("name").alias("store"))
    i = mart.item.select("itemid", F.col("name").alias("item"))
    um = mart.units.select(F.col("name").alias("uofm"), "base_uofm", "base_qty")
    rows = (td.join(F.broadcast(gl), "glaccountid")
              .join(t, "transactionid")
              .join(r, "locationid")
              .join(i, "itemid")
              .withColumnRenamed("unitofmeasurename", "uofm")
              .join(F.broadcast(um), "uofm")
              .select("store_id", "concept", "store", "item", "uofm", "base_uofm", "date",
                      "transactionid",
                      F.col("amount").alias("ext_amount"), "quantity",
                      nullif_div("amount", "quantity").alias("amount"),
                      nullif_div(nullif_div("amount", "quantity"), "base_qty").alias("base_amount")))
    picked = top_per_group(rows, ["store_id", "item"],
                           ["date", "transactionid", "ext_amount", "quantity", "uofm"],
                           descending=(pick == "last"))
    return picked.select("store_id", "concept", "store", "item", "uofm",
                         F.round("amount", 2).alias("amount"), "base_uofm",
                         F.round("base_amount", 4).alias("base_amount"))


def stockcount_category_totals(mart: Mart) -> DataFrame:
    """VW-02: stock-count value per day, store, account and category."""
    sc = mart.stock_count("Stock Count")
    return (sc.groupBy("date", "week", "period", "year", F.col("id").alias("store_id"), "store",
                       "account", "category1")
              .agg(F.round(F.sum("previous_amount"), 2).alias("previous"),
                   F.round(F.sum("amount"), 2).alias("amount")))


def stockcount_conversion(mart: Mart, as_of: str, months: int = 12) -> DataFrame:
    """VW-03: protein stock counts of the last year in counted units."""
    sc = (mart.stock_count("Stock Count")
              .filter(F.col("category2").isin(*PROTEIN_CATEGORIES))
              .filter(since("date", as_of, months=months))
              .filter(F.col("base_uofm").isNotNull()))
    ic = mart.item_conversion.select("itemid", "weight_qty")
    out = sc.join(ic, "itemid")
    each = F.when(F.col("weight_qty").isNull() | (F.col("weight_qty") == 0), F.lit(0.0)) \
            .otherwise(F.col("quantity") * F.col("base_qty") / F.col("weight_qty"))
    return out.select("date", "dow", "week", "period", "year", F.col("id").alias("store_id"),
                      "store", "type", "item", "uofm", "quantity", "base_uofm", "base_qty",
                      "weight_qty", F.round(each, 4).alias("each_conversion"))


def stockcount_monthly(mart: Mart, as_of: str, days: int = 30) -> DataFrame:
    """VW-04: every tracked (item, store) for each of the last ``days`` days,
    with the counted total or 0 (gap fill).

    One pass over the counts: a pair is tracked when it was ever counted, and
    carries its totals of the window, at most one per day, from which the days are
    generated (``inline`` over a date sequence).
    """
    end = F.to_date(F.lit(as_of))
    start = F.date_sub(end, days - 1)
    counted = mart.stock_count("Stock Count").filter(F.col("category1") == "Food")
    pair = [F.col("itemid").alias("item_id"), F.col("item").alias("item_name"), F.col("id").alias("store_id")]
    daily = (counted.select(*pair, F.when(F.col("date").between(start, end), F.col("date")).alias("day"), "quantity")
             .groupBy("item_id", "item_name", "store_id", "day").agg(F.sum("quantity").alias("total")))
    totals = F.map_from_entries(F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", "total"))))
    grid = F.transform(F.sequence(start, end), lambda d: F.struct(
        d.alias("date"), F.round(F.coalesce(F.try_element_at("totals", d), F.lit(0.0)), 4).alias("count_total")))
    return (daily.groupBy("item_id", "item_name", "store_id").agg(totals.alias("totals"))
                 .select("item_id", "item_name", "store_id", F.inline(grid))
                 .select("date", "item_id", "item_name", "store_id", "count_total"))


def stockcount_purchases(mart: Mart, as_of: str, months: int = 12) -> DataFrame:
    """VW-05: purchases of tracked items in the last year, in counted units.

    The original inner-joins the tracked list (one row per store listing the
    item) and then groups by every column to undo the fan-out; a semi-join
    plus ``distinct`` gives the same rows without the fan-out.
    """
    p = (mart.purchases.filter(since("date", as_of, months=months))
             .filter(F.col("quantity") > 0)
             .filter(F.col("base_uofm").isNotNull()))
    ic = mart.item_conversion.select("itemid", "weight_qty")
    tracked = mart.inv_items.select(F.col("item_name").alias("item")).distinct()
    unit_count = nullif_div(F.col("base_qty") * F.col("quantity"), F.col("weight_qty"))
    return (p.join(ic, "itemid")
             .join(tracked, "item", "left_semi")
             .select("transactionid", "date", "dow", "week", "period", "year",
                     F.col("id").alias("store_id"), "store", "item", "quantity", "uofm",
                     F.round(unit_count, 4).alias("unit_count"))
             .distinct())


def stockcount_waste(mart: Mart, fanout: bool = False) -> DataFrame:
    """VW-08: waste per day, store, item and unit, in base units.

    The original joins the tracked list on the item name only, so an item
    tracked in n stores has its sums multiplied by n; ``fanout=True``
    reproduces that, the default counts each waste line once.
    """
    sc = mart.stock_count("Waste Log").filter(F.col("base_uofm").isNotNull())
    tracked = mart.inv_items.groupBy(F.col("item_name").alias("item")).agg(F.count("*").alias("_listed"))
    # summed first, then multiplied by the number of listings: no row is copied
    times = F.col("_listed") if fanout else F.lit(1)
    return (sc.groupBy("date", "dow", "week", "period", "year", F.col("id").alias("store_id"),
                       "store", "item", "uofm", "base_qty", "base_uofm")
              .agg(F.sum("quantity").alias("quantity"))
              .join(tracked, "item").withColumn("quantity", F.col("quantity") * times)
              .select("date", "dow", "week", "period", "year", "store_id", "store", "item", "uofm",
                      F.round("quantity", 4).alias("quantity"), "base_uofm",
                      F.round(F.col("quantity") * F.col("base_qty"), 4).alias("base_qty")))


def register_views(mart: Mart, as_of: str) -> None:
    """Publish the views as temp views (the original recreates SQL views)."""
    current_base_cost(mart, "Beer").createOrReplaceTempView("current_base_cost_beer")
    current_base_cost(mart, "Liquor").createOrReplaceTempView("current_base_cost_liquor")
    current_base_cost(mart, "Wine").createOrReplaceTempView("current_base_cost_wine")
    stockcount_category_totals(mart).createOrReplaceTempView("stockcount_category_totals")
    stockcount_conversion(mart, as_of).createOrReplaceTempView("stockcount_conversion")
    stockcount_monthly(mart, as_of).createOrReplaceTempView("stockcount_monthly")
    stockcount_purchases(mart, as_of).createOrReplaceTempView("stockcount_purchases")
    stockcount_waste(mart).createOrReplaceTempView("stockcount_waste")
    sales.stockcount_sales(mart, as_of).createOrReplaceTempView("stockcount_sales")
    sales.stockcount_sales_single_concept(mart, as_of).createOrReplaceTempView("stockcount_sales_pos")
