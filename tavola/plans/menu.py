"""Menu engineering (DOM-01 .. DOM-04).

Inputs are the sales mix and the recipe cost per store and menu item. All
per-store and per-category work of the original's driver loops is a
``groupBy`` / join on (location, category) here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.functions.numeric import rating, safe_ratio
from tavola.functions.strings import strip_modifiers
from tavola.operators.aggregates import with_totals
from tavola.operators.filters import remove_special
from tavola.operators.ordering import number_rows
from tavola.operators.windows import vs_group_mean
from tavola.session import written
from tavola.sources.mart import Mart

# Stores that serve a bread basket and its default cost per
# entree when no bread-basket recipe cost exists for the store.
BREAD_BASKET_DEFAULTS = [(4, 0.19), (9, 0.19), (11, 0.84), (15, 0.96), (16, 0.69), (17, 0.84)]
BREAD_BASKET_ITEM = "Bread Basket per Entree"
BREAD_BASKET_PATTERN = "(?i)Bread.*Basket"
# Modifier words stripped from item names.
LEADING_MODIFIERS = ["Add", "Extra", "Lite", "On Side"]
TRAILING_MODIFIERS = ["On Side", "Only"]

MEASURE_COLS = ["quantity", "menu_price", "menu_cost", "margin", "cost_pct", "sales",
                "total_cost", "profit"]


def bread_basket_params(spark: SparkSession, rows=None) -> DataFrame:
    """Parameter table store_id -> default cost (small, broadcast)."""
    schema = T.StructType([T.StructField("store_id", T.LongType(), False),
                           T.StructField("default_cost", T.DoubleType(), False)])
    return spark.createDataFrame(rows or BREAD_BASKET_DEFAULTS, schema)


def _mix_with_cost(mart: Mart, fill_cost: bool) -> DataFrame:
    cost_col = F.coalesce(F.col("cost"), F.lit(0.0)) if fill_cost else F.col("cost")
    return (mart.mix_and_cost
              .select("location", "store_id", "concept", "menu_item",
                      F.col("qty").alias("quantity"), F.col("price").alias("menu_price"),
                      cost_col.alias("menu_cost"), "sales",
                      F.col("cat1").alias("category1"), F.col("cat2").alias("category2"),
                      F.col("cat3").alias("category3")))


def bread_basket(mart: Mart, mix: DataFrame, params: DataFrame) -> DataFrame:
    """DOM-03: one synthetic row per configured store: quantity = entrees
    sold, cost = the store's bread-basket recipe cost if one exists, else the
    configured default; price and sales 0."""
    entrees = (mix.filter(F.col("category2") == "Entree").groupBy("store_id")
                  .agg(F.sum("quantity").alias("entrees")))
    names = mart.item.select("itemid", F.col("name").alias("_item"))
    recipe = (mart.menu_cost.join(names, "itemid")
                  .filter(F.col("_item").rlike(BREAD_BASKET_PATTERN))
                  .groupBy("store_id").agg(F.min("cost").alias("recipe_cost")))
    stores = mart.restaurants.select(F.col("id").alias("store_id"), F.col("name").alias("location"))
    return (F.broadcast(params).join(stores, "store_id")
             .join(entrees, "store_id", "left")
             .join(recipe, "store_id", "left")
             .select("location", "store_id", F.lit("Steakhouse").alias("concept"),
                     F.lit(BREAD_BASKET_ITEM).alias("menu_item"),
                     F.coalesce(F.col("entrees"), F.lit(0.0)).alias("quantity"),
                     F.lit(0.0).alias("menu_price"),
                     F.coalesce(F.col("recipe_cost"), F.col("default_cost")).alias("menu_cost"),
                     F.lit(0.0).alias("sales"), F.lit("Food").alias("category1"),
                     F.lit("No Charge").alias("category2"), F.lit("None").alias("category3")))


def add_metrics(df: DataFrame) -> DataFrame:
    """PRJ-10 / NUM-01: cost %, margin, total cost and profit."""
    return (df.withColumn("cost_pct", safe_ratio("menu_cost", "menu_price", 0.0))
              .withColumn("margin", F.col("menu_price") - F.col("menu_cost"))
              .withColumn("total_cost", F.col("quantity") * F.col("menu_cost"))
              .withColumn("profit", F.col("quantity") * F.col("margin")))


def _rounded(df: DataFrame, cols: Sequence[str], n: int = 4) -> DataFrame:
    return df.select(*[F.round(c, n).alias(c) if c in cols else F.col(c) for c in df.columns])


def menu_engineering(mart: Mart, date: str, year: int, period: int,
                     params: DataFrame | None = None) -> DataFrame:
    """DOM-01: per store and menu item price, cost, margin, cost %, total
    cost and profit, with the bread-basket rows. Missing categories become
    "None" first, so uncategorised items stay; then rows with any null left
    (a null price, say) are dropped, as in the original."""
    params = params if params is not None else bread_basket_params(mart.spark)
    mix = _mix_with_cost(mart, fill_cost=True).fillna(
        "None", ["category1", "category2", "category3"])
    rows = mix.unionByName(bread_basket(mart, mix, params))
    out = (add_metrics(rows)
           .withColumn("date", F.to_date(F.lit(date)))
           .withColumn("year", F.lit(year)).withColumn("period", F.lit(period))
           .select("location", "store_id", "date", "year", "period", "concept", "menu_item",
                   *MEASURE_COLS, "category1", "category2", "category3")
           .dropna("any"))
    return _rounded(out, MEASURE_COLS)


def rated_items(mart: Mart, exclusions: DataFrame | None) -> DataFrame:
    """DOM-02 detail: items of each store rated against the means of their
    (store, category) group. Cost stays null when the item has no recipe
    cost (so margin is null and counts as "not below the mean")."""
    mix = _mix_with_cost(mart, fill_cost=False)
    mix = remove_special(mix, "menu_item", exclusions)
    mix = mix.withColumn("menu_item", strip_modifiers("menu_item", LEADING_MODIFIERS,
                                                      TRAILING_MODIFIERS))
    # read for the rows and for the means; what follows from a row's columns is not written or shuffled
    mix = written(mix.withColumn("category2", F.coalesce("category2", F.lit("None"))), tidy=True)
    flagged = vs_group_mean(mix.withColumn("margin", F.col("menu_price") - F.col("menu_cost")),
                            ["location", "category2"], {"qty_high": "quantity", "margin_high": "margin"})
    return add_metrics(flagged).withColumn("rating", rating("qty_high", "margin_high")).drop(
        "qty_high", "margin_high")


def menu_rating(mart: Mart, exclusions: DataFrame | None) -> DataFrame:
    out = rated_items(mart, exclusions).select(
        "location", "category2", "menu_item", "quantity", "menu_price", "menu_cost", "margin",
        "cost_pct", "sales", "total_cost", "profit", "category1", "rating")
    return _rounded(out, MEASURE_COLS)


def menu_rating_totals(mart: Mart, exclusions: DataFrame | None) -> DataFrame:
    """DOM-02 + AGG-08: the rated detail plus one 'Total' row per store and
    category (quantity, sales, total cost and profit summed; cost % from
    the totals, 1 when there are no sales)."""
    detail = written(menu_rating(mart, exclusions), tidy=True)  # read for the rows, their totals and by who sorts them
    out = with_totals(detail, ["location", "category2"],
                      ["quantity", "sales", "total_cost", "profit"],
                      ratios={"cost_pct": ("total_cost", "sales", 1.0)})
    return _rounded(out, MEASURE_COLS)


REPORT_ORDER = {"sales": [("profit", "desc"), ("quantity", "desc")], "quantity": [("quantity", "desc"), ("profit", "desc")]}


def menu_report(mart: Mart, exclusions: DataFrame | None, sort_by: str = "sales") -> DataFrame:
    """SRT-01/02 / SNK-04: the rated items as the stores' report prints them.

    Stores and categories ascend, a category is closed by its totals row, items
    descend by profit and quantity (or the other way round), ties by name.
    ``line`` is the line number over the whole report.
    """
    rows = menu_rating_totals(mart, exclusions).withColumn("closes", F.col("row_type") == "Total")
    keys = ["location", "category2", "closes", *REPORT_ORDER[sort_by], "menu_item", "menu_price", "menu_cost", "sales"]
    return number_rows(rows, keys, "line").drop("closes")


def uncategorised_items(mart: Mart, exclusions: DataFrame | None, sort_by: str = "sales",
                        k: int = 25) -> DataFrame:
    """DOM-04 / DQ-06: items without a menu category, summed over stores and
    ranked (top ``k`` by ``sort_by``, ties by name)."""
    mix = _mix_with_cost(mart, fill_cost=False)
    mix = remove_special(mix, "menu_item", exclusions)
    mix = add_metrics(mix).filter(F.col("category2").isNull())
    summed = mix.groupBy("menu_item").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in MEASURE_COLS])
    top = summed.orderBy(F.col(sort_by).desc(), F.col("menu_item")).limit(k)
    return _rounded(top, MEASURE_COLS)


def specialty_items(mart: Mart, brand: str = "Brand#13") -> DataFrame:
    """Exclusion list used by the registered queries: every menu item of one
    specialty brand (a rule over the part table, not a fixed list)."""
    return (mart.raw("part").filter(F.col("p_brand") == brand)
                .select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name")))
