"""Theoretical usage: sales of menu items turned into counted ingredients (VW-06, VW-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.dates import since
from tavola.operators.calendar import FISCAL_NAMES, fiscal_columns
from tavola.operators.joins import single_value
from tavola.plans.recipes import MENU_PART_TYPE, PREP_PREFIX, recipe_edges, to_base_units
from tavola.sources.mart import CONCEPTS, FISCAL_EPOCH, Mart

# Base units that convert to counted units by weight.
COUNTED_UNITS = ("OZ-wt", "OZ-fl", "Each")


def recipe_ingredients(mart: Mart) -> DataFrame:
    """Direct ingredients (concept, menu_item, recipe, ingredient, qty, uofm)
    of every menu item, and of every prep recipe under its ``PREP`` name."""
    raw = recipe_edges(mart)
    edges = to_base_units(raw, mart.units)
    prep = raw.select(F.col("parent").alias("child")).distinct().withColumn("_prep", F.lit(True))
    part = mart.raw("part").select(F.col("p_partkey").alias("parent"), "p_type",
                                   F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("parent_name"))
    names = mart.item.select(F.col("itemid").alias("child"), F.col("name").alias("_name"))
    recipe = F.concat(F.lit(PREP_PREFIX), F.col("parent_name"))
    rows = (edges.join(part, "parent").join(names, "child").join(prep, "child", "left")
                 .select(F.when(F.col("parent") % 2 == 0, F.lit(CONCEPTS[0])).otherwise(F.lit(CONCEPTS[1])).alias("concept"),
                         F.explode(F.when(F.col("p_type") == MENU_PART_TYPE, F.array(F.col("parent_name"), recipe))
                                    .otherwise(F.array(recipe))).alias("menu_item"),
                         recipe.alias("recipe"),
                         F.when(F.col("_prep"), F.concat(F.lit(PREP_PREFIX), F.col("_name")))
                          .otherwise(F.col("_name")).alias("ingredient"), "qty", "uofm"))
    return rows


def prep_mapping(ri: DataFrame) -> DataFrame:
    """REC-05 / JN-07 / FLT-08: prep ingredient -> what the recipes using it are made of
    (a self-join of the edge table on recipe = menu item)."""
    users = ri.filter(F.col("ingredient").like("PREP%")).select(F.col("ingredient").alias("prep_ingredient"), "recipe").distinct()
    made_of = ri.select(F.col("menu_item").alias("recipe"), F.col("ingredient").alias("actual_ingredient")).distinct()
    return users.join(made_of, "recipe").select("prep_ingredient", "actual_ingredient").distinct()


def _menu_sales(mart: Mart, as_of: str, status: str | None = None) -> DataFrame:
    """Sales of the last month per day, store and menu item."""
    orders = mart.raw("orders").filter(since(F.to_date("o_orderdate"), as_of, months=1))
    if status:
        orders = orders.filter(F.col("o_orderstatus") == status)
    menu = mart.raw("part").filter(F.col("p_type") == MENU_PART_TYPE).select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("menuitem"))
    stores = mart.restaurants.select(F.col("id").alias("store_id"), F.col("name").alias("store"), F.col("concept").alias("_concept"))
    day = (mart.raw("lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("date")),
                                     "l_orderkey")
           .groupBy("date", F.col("l_suppkey").alias("store_id"), "l_partkey").agg(F.sum("l_quantity").alias("sales_count")))
    fiscal = [c for c, n in zip(fiscal_columns("date", FISCAL_EPOCH), FISCAL_NAMES) if n in ("dow", "week", "period", "year")]
    return day.join(menu, "l_partkey").join(stores, "store_id").select("*", *fiscal)


def _usage(mart: Mart, sold: DataFrame, ri: DataFrame) -> DataFrame:
    mapping = prep_mapping(ri)
    tracked = mart.inv_items.select(F.col("item_name").alias("ingredient")).distinct()
    ic = mart.item_conversion.select(F.col("name").alias("ingredient"), "weight_qty")
    used = (sold.join(ri.select(F.col("menu_item").alias("menuitem"), "concept", F.col("ingredient").alias("named"), "qty",
                                F.col("uofm").alias("base_uofm")), "menuitem")
                .filter(F.col("concept") == F.col("_concept"))
                .join(mapping, F.col("named") == F.col("prep_ingredient"), "left")
                # JN-08: the join key is an expression, computed once as a column
                .withColumn("ingredient", F.coalesce("actual_ingredient", "named"))
                .join(tracked, "ingredient", "left_semi").join(ic, "ingredient"))
    base = F.col("qty") * F.col("sales_count")
    counted = F.when((F.col("weight_qty") > 0) & F.col("base_uofm").isin(*COUNTED_UNITS), base / F.col("weight_qty")).otherwise(1.0)
    key = ["date", "dow", "week", "period", "year", "store_id", "store", "menuitem", "sales_count", "ingredient", "concept",
           "qty", "base_uofm", "weight_qty"]
    return (used.select(*key).distinct()
                .select(*key[:11], F.round(base, 4).alias("base_usage"), "base_uofm", F.round(counted, 4).alias("count_usage")))


def stockcount_sales(mart: Mart, as_of: str) -> DataFrame:
    """VW-06: per day, store and menu item sold in the last month, the tracked
    ingredients used (prep recipes replaced by their ingredients), in base and
    counted units; recipes of the store's own concept."""
    return _usage(mart, _menu_sales(mart, as_of), recipe_ingredients(mart))


def stockcount_sales_single_concept(mart: Mart, as_of: str) -> DataFrame:
    """VW-07: the same over the point-of-sale detail, which has no concept:
    each menu item is taken in one concept of its recipes, the first by name
    (JN-15)."""
    ri = recipe_ingredients(mart)
    one = single_value(ri, "menu_item", "concept").select(F.col("menu_item").alias("menuitem"), F.col("concept").alias("_concept"))
    return _usage(mart, _menu_sales(mart, as_of, status="F").drop("_concept").join(one, "menuitem"), ri)
