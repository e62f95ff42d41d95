"""Small record jobs over landed JSON: menu tree, item dictionary, store settings,
payment id lists, known-prefix names (REC-04, NST-07..09, SET-02, STR-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.nested import pick
from tavola.functions.strings import default_text
from tavola.functions.util import as_col
from tavola.operators.recursive import explode_levels
from tavola.operators.windows import dedup
from tavola.sources.mart import Mart


# -- REC-04: menu group tree -----------------------------------------------------
def landed_menus(mart: Mart) -> DataFrame:
    """Menu documents, one per part: brand, type and (for even sizes) a size
    group, nested, with items at the inner levels."""
    p = F.col("p_partkey").cast("string")
    def item(prefix):
        name = F.concat(F.lit(prefix), "p_name", F.lit(" "), p)
        return F.struct(name.alias("name"), F.upper(name).alias("posName"),
                        F.when(F.col("p_size") % 3 != 0, F.lower(name)).alias("kitchenName"))
    size = F.struct(F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("name"), F.array(item("Large ")).alias("menuItems"))
    kind = F.struct(F.col("p_type").alias("name"), F.array(item("")).alias("menuItems"),
                    F.when(F.col("p_size") % 2 == 0, F.array(size)).alias("menuGroups"))
    menu = F.struct(F.col("p_brand").alias("name"), F.array(kind).alias("menuGroups"))
    return mart.raw("part").select(F.col("p_partkey").alias("menu_id"), F.to_json(menu).alias("node"))


def flatten_menu(menus: DataFrame, checkpoint: bool = True) -> DataFrame:
    """REC-04: every item of a menu with the path of its groups ("A > B"), for
    trees of any depth."""
    def node(v, path, *keep):
        return [*keep, path.alias("path"), F.try_variant_get(v, "$.menuItems", "array<variant>").alias("items"),
                F.try_variant_get(v, "$.menuGroups", "array<variant>").alias("groups")]

    def name(v):
        return F.try_variant_get(v, "$.name", "string")

    def emit(level: DataFrame) -> DataFrame:
        rows = level.select("menu_id", "menu", "path", F.explode("items").alias("i"))
        return rows.select("menu_id", "menu", "path", *[F.try_variant_get("i", f"$.{k}", "string").alias(n) for k, n in
                                                       (("name", "item"), ("posName", "pos_name"), ("kitchenName", "kitchen_name"))])

    def children(level: DataFrame) -> DataFrame:
        down = level.select("menu_id", "menu", "path", F.explode("groups").alias("v"))
        return down.select(*node(F.col("v"), F.concat_ws(" > ", "path", name("v")), "menu_id", "menu"))

    parsed = menus.select("menu_id", F.try_parse_json("node").alias("v")).withColumn("menu", name("v"))
    return explode_levels(parsed.select(*node(F.col("v"), F.col("menu"), "menu_id", "menu")), children, emit, F.size("groups") > 0, checkpoint)


def menu_tree(mart: Mart) -> DataFrame:
    return flatten_menu(landed_menus(mart))


# -- NST-07: item dictionary -----------------------------------------------------------
def pos_item_dictionary(mart: Mart) -> DataFrame:
    """Item id -> name, the last name written."""
    rows = mart.raw("events").select(F.get_json_object("props", "$.k").alias("id"),
                                     F.concat(F.lit("Item "), "event_type").alias("name"), "ts", "event_id")
    return dedup(rows, ["id"], ["ts", "event_id"], keep="last").select("id", "name")


# -- NST-08/09: record projections -------------------------------------------------------
def store_config(mart: Mart) -> DataFrame:
    """NST-09: general settings per store, missing text as ""."""
    s = F.col("s_suppkey")
    general = F.struct(F.col("s_name").alias("name"), F.when(s % 3 != 0, F.concat(F.lit("Site "), s.cast("string"))).alias("locationName"),
                       F.when(s % 4 != 0, F.lpad(s.cast("string"), 6, "0")).alias("locationCode"))
    docs = mart.raw("supplier").select(F.to_json(F.struct(s.alias("guid"), F.when(s % 5 != 0, general).alias("general"))).alias("j"))
    rows = docs.select(F.from_json("j", "guid long, general struct<name: string, locationName: string, locationCode: string>").alias("r")).select("r.*")
    out = pick(rows, {"store_id": "guid", "name": "general.name", "location_name": "general.locationName", "location_code": "general.locationCode"})
    return out.select("store_id", *[default_text(c, "").alias(c) for c in ("name", "location_name", "location_code")])


def daily_sales_totals(mart: Mart) -> DataFrame:
    """NST-08: totals of the daily sales records per store and day."""
    day = F.to_date("ts")
    rec = F.struct(F.struct((F.col("user_id") % 20).alias("id")).alias("location"), F.date_format(day, "yyyy-MM-dd").alias("date"),
                   F.struct(F.col("value").alias("netSales"), (F.col("event_type") == "purchase").cast("int").alias("guestCount")).alias("totals"))
    docs = mart.raw("events").select(F.to_json(rec).alias("j"))
    rows = docs.select(F.from_json("j", "location struct<id: long>, date string, totals struct<netSales: double, guestCount: int>").alias("r")).select("r.*")
    flat = pick(rows, {"store_id": "location.id", "date": "date", "net_sales": "totals.netSales", "guest_count": "totals.guestCount"})
    return flat.groupBy("store_id", "date").agg(F.sum(F.col("net_sales").cast("decimal(20,4)")).cast("double").alias("net_sales"),
                                                F.sum("guest_count").alias("guest_count"))


# -- SET-02: payment ids --------------------------------------------------------------
def payment_ids(mart: Mart) -> DataFrame:
    """Ids of paid, refunded and voided payments of a day, duplicates kept."""
    e = mart.raw("events").select(F.to_date("ts").alias("date"), F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("guid"),
                                  "event_type", "event_id")
    paid = e.filter(F.col("event_type") == "purchase")
    refund = paid.filter(F.col("event_id") % 7 == 0)
    void = e.filter(F.col("event_type") == "error")
    return paid.unionByName(refund).unionByName(void).groupBy("date").agg(F.count("guid").alias("listed"), F.countDistinct("guid").alias("ids"))


# -- STR-14: known prefixes ------------------------------------------------------------
def strip_known_prefix(df: DataFrame, col: str, prefixes: DataFrame, out: str) -> DataFrame:
    """STR-14: remove the longest known prefix (and the blank after it) from a
    name; names without one stay, nulls too.

    Names and prefixes are paths of words in a trie. Every distinct name emits
    the hash of each of its proper word prefixes once, up to the depth of the
    longest known prefix, and meets known prefixes of the same depth and hash;
    equal texts are checked after the join. A first word that all names share is
    no hot key, and a name costs as many rows as it has words.
    """
    name = as_col(col)
    known = (prefixes.select(F.col(prefixes.columns[0]).alias("_p")).filter("_p <> ''").distinct()
             .withColumn("_w", F.split("_p", " ")).select("_p", F.size("_w").alias("_depth"), F.xxhash64("_w").alias("_hash")))
    deepest = known.agg(F.max("_depth")).first()[0] or 0
    names = df.select(name.alias("_n")).filter(F.col("_n").isNotNull()).distinct().withColumn("_w", F.split("_n", " "))
    paths = (names.withColumn("_last", F.least(F.size("_w") - 1, F.lit(deepest))).filter("_last > 0")
             .select("_n", "_w", F.explode(F.sequence(F.lit(1), F.col("_last"))).alias("_depth"))
             .select("_n", "_depth", F.xxhash64(F.slice("_w", F.lit(1), F.col("_depth"))).alias("_hash")))
    best = (paths.join(known, ["_depth", "_hash"]).filter(F.col("_n").startswith(F.concat("_p", F.lit(" "))))
                 .groupBy("_n").agg(F.max(F.length("_p")).alias("_l")))
    return (df.join(best, name == F.col("_n"), "left")
              .withColumn(out, F.when(F.col("_l").isNotNull(), F.expr(f"substring(`{col}`, _l + 2)")).otherwise(name)).drop("_n", "_l"))


def item_part_b(mart: Mart) -> DataFrame:
    part = mart.raw("part")
    items = part.select(F.col("p_partkey").alias("itemid"),
                        F.when(F.col("p_size") % 4 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", "p_type", "p_brand", "p_name")).alias("name"))
    known = part.select("p_type").distinct().unionByName(
        part.filter(F.col("p_size") % 2 == 0).select(F.concat_ws(" ", "p_type", "p_brand").alias("p_type")).distinct())
    return strip_known_prefix(items, "name", known, "part_b").select("itemid", "name", "part_b")
