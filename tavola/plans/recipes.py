"""Recipe jobs: base-unit ingredients and the flat explosion (DOM-07/08/10).

Recipe graph of the mart (derived from the part table, so it grows with
it): part ``k`` has the components ``2k+1``, ``2k+2`` and ``3k+5`` when those
parts exist; a part with components is a prep recipe (named ``PREP <item>``),
one without is a raw ingredient. Every component key is larger than its
recipe key, so the graph is acyclic. Menu items are the parts of the PROMO
type; each is exploded from its own recipe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.numeric import conversion_factor, is_known_pair
from tavola.functions.util import case_map
from tavola.operators.recursive import explode_bom
from tavola.sources.mart import Mart

# The unit a component is measured in (component key % 4) and
# its quantity in that unit; the menu-item part type; the yield rule
# (1 + key % 3 portions, 'Each').
COMPONENT_UNIT = {0: "Each", 1: "OZ-wt", 2: "OZ-fl", 3: "LB"}
COMPONENT_QTY = {0: 0.25, 1: 0.5, 2: 0.75, 3: 0.0625}
MENU_PART_TYPE = "PROMO"
PREP_PREFIX = "PREP "


def recipe_edges(mart: Mart) -> DataFrame:
    """Component edges (parent, child, qty, uofm) in recipe units."""
    k = F.col("p_partkey")
    parts = mart.raw("part").select("p_partkey")
    kids = parts.select(k.alias("parent"),
                        F.explode(F.array(k * 2 + 1, k * 2 + 2, k * 3 + 5)).alias("child"))
    exists = parts.select(F.col("p_partkey").alias("child"))
    return (kids.join(exists, "child")
                .select("parent", "child",
                        case_map(F.col("child") % 4, COMPONENT_QTY).alias("qty"),
                        case_map(F.col("child") % 4, COMPONENT_UNIT).alias("uofm")))


def to_base_units(edges: DataFrame, units: DataFrame) -> DataFrame:
    """NUM-09: quantity x the unit's base quantity, unit -> base unit (a
    component in an unknown unit keeps a null quantity and unit)."""
    um = units.select(F.col("name").alias("uofm"), "base_uofm", "base_qty")
    return (edges.join(F.broadcast(um), "uofm", "left")
                 .select("parent", "child", (F.col("qty") * F.col("base_qty")).alias("qty"),
                         F.col("base_uofm").alias("uofm")))


def recipe_yields(edges: DataFrame) -> DataFrame:
    """Base-unit yield of every prep recipe."""
    return (edges.select(F.col("parent").alias("recipe")).distinct()
                 .withColumn("yield", (F.col("recipe") % 3 + 1).cast("double")))


def menu_roots(mart: Mart) -> DataFrame:
    return (mart.raw("part").filter(F.col("p_type") == MENU_PART_TYPE)
                .select(F.col("p_partkey").alias("root"), F.col("p_partkey").alias("recipe")))


def recipe_explosion(mart: Mart, checkpoint: bool = True) -> DataFrame:
    """DOM-08 (``recipe_ingredients_flat``): raw ingredients per menu item in
    base units, summed over every path through prep recipes."""
    edges = to_base_units(recipe_edges(mart), mart.units)
    leaves, _ = explode_bom(edges, recipe_yields(edges), menu_roots(mart),
                            on_error="raise", checkpoint=checkpoint)
    names = mart.item.select(F.col("itemid").alias("child"), F.col("name").alias("ingredient"))
    return (leaves.join(names, "child")
                  .select(F.col("root").alias("menu_item_id"), F.col("child").alias("item_id"),
                          "ingredient", "uofm", F.round("qty", 9).alias("qty"), "depth"))


def menu_item_recipes(mart: Mart) -> DataFrame:
    """DOM-08 bridge: menu item -> its recipe (menu items with components)."""
    parents = recipe_edges(mart).select(F.col("parent").alias("recipe")).distinct()
    return (menu_roots(mart).join(parents, "recipe", "left_semi")
                            .select(F.col("root").alias("menu_item_id"),
                                    F.col("recipe").alias("recipe_id")))


def recipe_base_units(mart: Mart) -> DataFrame:
    """DOM-07 (``recipe_ingredients``): direct ingredients of each menu
    recipe in base units, with concept and names; prep components keep their
    ``PREP`` name."""
    raw = recipe_edges(mart)
    edges = to_base_units(raw, mart.units)
    prep = raw.select(F.col("parent").alias("child")).distinct().withColumn("_prep", F.lit(True))
    names = mart.item.select(F.col("itemid").alias("child"), F.col("name").alias("_name"))
    roots = menu_roots(mart).select(F.col("recipe").alias("parent"), "root")
    rn = mart.item.select(F.col("itemid").alias("root"), F.col("name").alias("menu_item"))
    return (edges.join(roots, "parent")
                 .join(rn, "root")
                 .join(names, "child")
                 .join(prep, "child", "left")
                 .select(F.when(F.col("root") % 2 == 0, F.lit("Casual")).otherwise(F.lit("Steakhouse"))
                          .alias("concept"),
                         "menu_item",
                         F.concat(F.lit(PREP_PREFIX), F.col("menu_item")).alias("recipe"),
                         F.when(F.col("_prep"), F.concat(F.lit(PREP_PREFIX), F.col("_name")))
                          .otherwise(F.col("_name")).alias("ingredient"),
                         F.round("qty", 6).alias("qty"), "uofm"))


def menu_cost_converted(mart: Mart) -> DataFrame:
    """DOM-10 / NUM-07: cost of each exploded ingredient of a menu item in
    the unit its price is quoted in: recipe quantity x conversion factor
    (from the item's weight / volume / each equivalents) x the item's
    cheapest newest base cost over the stores. Cost and unit come from the
    same store's row (ties: unit, then store); a row without cost counts
    only where no store has one."""
    from tavola.plans.cost import latest_item_price
    flat = recipe_explosion(mart)
    cheapest = F.min(F.struct(F.col("base_cost").isNull(), "base_cost", "base_uofm", "id"))
    price = (latest_item_price(mart)
             .groupBy(F.col("itemid").alias("item_id")).agg(cheapest.alias("p"))
             .select("item_id", "p.base_cost", "p.base_uofm"))
    conv = mart.item_conversion.select(F.col("itemid").alias("item_id"), "weight_qty",
                                       "volume_qty", "each_qty")
    j = flat.join(price, "item_id").join(conv, "item_id")
    factor = conversion_factor("uofm", "base_uofm")
    return j.select("menu_item_id", "item_id", "uofm", "base_uofm", "qty",
                    F.round(factor, 6).alias("factor"),
                    is_known_pair("uofm", "base_uofm").alias("known_pair"),
                    F.round(F.col("qty") * factor * F.col("base_cost"), 4).alias("cost"))
