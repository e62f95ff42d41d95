"""Dimension and report loads as upserts of landed records (DOM-06, 11, 13, 16, 19, 20, NST-08).

Each job lands nested records as JSON text, takes the wanted fields, keeps the
last record of an id and merges the batch into the table as it was before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.nested import pick
from tavola.functions.util import case_map
from tavola.operators import merge
from tavola.operators.calendar import fiscal_week_index
from tavola.operators.windows import dedup
from tavola.operators.recursive import materialise
from tavola.plans import cost, dims, pos, reports
from tavola.plans.feeds import landed
from tavola.plans.recipes import PREP_PREFIX, recipe_edges, recipe_yields
from tavola.session import written
from tavola.sources.mart import FISCAL_EPOCH, ITEM_CATEGORY1, Mart

STAMP = "2001-08-01"


def _load(batch: DataFrame, key: str) -> DataFrame:
    """Upsert of a batch that sends some ids twice; the table before holds every third id under another name."""
    last = dedup(batch, [key], ["seq"], keep="last").drop("seq")
    before = last.filter(F.col(key) % 3 == 0).withColumn("name", F.concat(F.lit("old "), "name"))
    gone = last.filter(F.col(key) % 5 == 0).withColumn(key, -F.col(key) - 1)  # ids that the batch does not hold
    return merge.upsert(before.unionByName(gone), last, [key])


def _sent(df: DataFrame, key: Column, record: list[Column], schema: str) -> DataFrame:
    """Records with their order of sending: all once, every fourth before that with another name."""
    twice = F.when(key % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    rows = df.withColumn("seq", F.explode(twice))
    return landed(rows, F.struct(*record, F.col("seq")), schema + ", seq int")


def gl_accounts(mart: Mart) -> DataFrame:
    """glaccount: id, name, number and type."""
    k = F.col("n_nationkey")
    rec = [k.alias("id"), F.concat(F.when(F.col("seq") == 1, "first ").otherwise(""), "n_name").alias("name"),
           F.concat(F.lit("4"), F.lpad(k.cast("string"), 3, "0")).alias("number"),
           F.struct(F.when(k % 2 == 0, "Sales").otherwise("Cost").alias("name")).alias("glType")]
    rows = _sent(mart.raw("nation"), k, rec, "id long, name string, number string, glType struct<name: string>")
    return _load(pick(rows, {"glaccountid": "id", "name": "name", "glaccountnumber": "number", "gltype": "glType.name", "seq": "seq"}), "glaccountid")


def locations(mart: Mart) -> DataFrame:
    """location: id, name and number."""
    k = F.col("s_suppkey")
    rec = [k.alias("id"), F.concat(F.when(F.col("seq") == 1, "first ").otherwise(""), "s_name").alias("name"),
           F.when(k % 7 != 0, F.lpad(k.cast("string"), 4, "0")).alias("number")]
    rows = _sent(mart.raw("supplier"), k, rec, "id long, name string, number string")
    return _load(pick(rows, {"locationid": "id", "name": "name", "locationnumber": "number", "seq": "seq"}), "locationid")


def companies(mart: Mart) -> DataFrame:
    """company: vendors by id."""
    k = F.col("c_custkey")
    rec = [k.alias("id"), F.concat(F.when(F.col("seq") == 1, "first ").otherwise(""), "c_name").alias("name")]
    return _load(pick(_sent(mart.raw("customer"), k, rec, "id long, name string"), {"companyid": "id", "name": "name", "seq": "seq"}), "companyid")


def _named(value: Column, missing: Column) -> Column:
    """A nested object with a name, or none."""
    return F.when(~missing, F.struct(value.alias("name")))


def items(mart: Mart) -> DataFrame:
    """item: three categories, each null where its object is missing."""
    k, size = F.col("p_partkey"), F.col("p_size")
    rec = [k.alias("id"), F.concat(F.when(F.col("seq") == 1, "first ").otherwise(""), "p_name").alias("name"),
           _named(case_map(size % 3, ITEM_CATEGORY1), size % 7 == 0).alias("itemCategory1"),
           _named(F.col("p_type"), size % 6 == 0).alias("itemCategory2"), _named(F.col("p_brand"), size % 5 == 0).alias("itemCategory3")]
    kinds = ", ".join(f"itemCategory{n} struct<name: string>" for n in (1, 2, 3))
    rows = _sent(mart.raw("part"), k, rec, "id long, name string, " + kinds)
    return _load(pick(rows, {"itemid": "id", "name": "name", **{f"category{n}": f"itemCategory{n}.name" for n in (1, 2, 3)}, "seq": "seq"}), "itemid")


def purchase_items_all(mart: Mart) -> DataFrame:
    """purchase_item, all nineteen columns."""
    k, size = F.col("p_partkey"), F.col("p_size")
    objects = {"reporting_uofm": ("reportingUnitOfMeasure", F.lit("Each"), 2), "inventory_uofm": ("inventoryUnitOfMeasure", F.lit("LB"), 3),
               "category1": ("itemCategory1", F.col("p_type"), 7), "category2": ("itemCategory2", F.col("p_brand"), 6),
               "category3": ("itemCategory3", F.col("p_name"), 5), "cost_account": ("costAccount", F.lit("Food Cost"), 4),
               "inventory_account": ("inventoryAccount", F.lit("Inventory"), 8), "waste_account": ("wasteAccount", F.lit("Waste"), 9),
               "weight_uofm": ("equivalenceWeightUnitOfMeasure", F.lit("OZ-wt"), 10), "volume_uofm": ("equivalenceVolumeUnitOfMeasure", F.lit("OZ-fl"), 11),
               "each_uofm": ("equivalenceEachUnitOfMeasure", F.lit("Each"), 12)}
    plain = {"key_item": ("isKeyItem", "boolean", size % 2 == 0), "weight_qty": ("equivalenceWeightQuantity", "double", (size % 5).cast("double")),
             "volume_qty": ("equivalenceVolumeQuantity", "double", (size % 4 + 1).cast("double")),
             "each_qty": ("equivalenceEachQuantity", "double", (size % 3 + 1).cast("double")),
             "measure_type": ("measureType", "string", F.when(size % 2 == 0, "Weight").otherwise("Volume")), "active": ("isActive", "boolean", size % 9 != 0)}
    rec = [k.alias("id"), F.concat_ws(" ", "p_name", k.cast("string")).alias("name"),
           *[_named(v, size % n == 0).alias(field) for field, v, n in objects.values()], *[v.alias(field) for field, _, v in plain.values()]]
    schema = "id long, name string, " + ", ".join([f"{f} struct<name: string>" for f, _, _ in objects.values()] + [f"{f} {t}" for f, t, _ in plain.values()])
    batch = pick(landed(mart.raw("part"), F.struct(*rec), schema), {
        "item_id": "id", "item_name": "name", **{c: f"{f}.name" for c, (f, _, _) in objects.items()}, **{c: f for c, (f, _, _) in plain.items()}})
    before = batch.filter("item_id % 3 = 0").withColumn("item_name", F.lit("old")).withColumn("active", F.lit(None).cast("boolean"))
    return merge.upsert(before, batch, ["item_id"])


def recipe_table(mart: Mart) -> DataFrame:
    """recipes: name, reporting unit, yield unit and quantity of every recipe."""
    y = recipe_yields(recipe_edges(mart)).withColumnsRenamed({"recipe": "itemid", "yield": "yield_qty"})
    batch = y.join(mart.item.select("itemid", "name"), "itemid").select(
        F.concat(F.lit(PREP_PREFIX), "name").alias("recipe_name"), F.lit("Each").alias("reporting_uofm"),
        F.when(F.col("itemid") % 2 == 0, "Each").otherwise("OZ-wt").alias("yield_uofm"), "yield_qty", F.col("itemid").alias("recipe_id"))
    before = batch.filter("recipe_id % 3 = 0").withColumn("yield_qty", F.lit(0.0))
    return merge.upsert(before, batch, ["recipe_id"])


def inventory_headers(mart: Mart) -> DataFrame:
    """NST-08: the headers of the stock counts."""
    o = mart.raw("orders").filter("o_orderstatus = 'O'")
    k = F.col("o_orderkey")
    rec = F.struct(k.alias("id"), F.concat(F.lit("Count "), k.cast("string")).alias("name"), F.when(k % 3 == 0, "Approved").otherwise("Open").alias("status"),
                   F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), (k % 4 == 0).alias("isGLPosting"), F.col("o_totalprice").alias("totalAmount"),
                   F.when(k % 5 != 0, k % 3).alias("alertsCount"), F.struct(F.col("o_custkey").alias("id")).alias("location"))
    rows = landed(o, rec, "id long, name string, status string, date string, isGLPosting boolean, totalAmount double, alertsCount long")
    return pick(rows, {"id": "id", "name": "name", "status": "status", "date": "date", "is_gl_posting": "isGLPosting", "total_amount": "totalAmount",
                       "alerts_count": "alertsCount"}).fillna({"alerts_count": 0})


def invoice_headers(mart: Mart) -> DataFrame:
    """NST-08: the headers of the vendor invoices."""
    o = mart.raw("orders").filter("o_orderstatus = 'F'")
    k = F.col("o_orderkey")
    rec = F.struct(k.alias("id"), F.concat(F.lit("Invoice "), k.cast("string")).alias("name"), F.lpad(k.cast("string"), 8, "0").alias("number"),
                   F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                   (k % 3 == 0).alias("isPaid"), F.array(F.struct(k.alias("line"))).alias("lines"))
    rows = landed(o, rec, "id long, name string, number string, amount double, status string, date string, isPaid boolean")
    return pick(rows, {"id": "id", "name": "name", "number": "number", "amount": "amount", "status": "status", "date": "date", "is_paid": "isPaid"})


def product_mix_table(mart: Mart) -> DataFrame:
    """DOM-11: the product mix merged into its table on (item, day, store); changed and new rows carry the update stamp."""
    mix = materialise(pos.product_mix(mart), True)
    before = mix.filter("store_id % 2 = 0").withColumn("qty_sold", F.lit(-1.0)).withColumn("last_update", F.to_date(F.lit("2000-01-01")))
    batch = mix.filter("store_id % 3 = 0")
    return merge.upsert(before, batch, ["item_guid", "date", "store_id"],
                        ["item_name", "qty_sold", "menu_item_price", "gross_item_amt", "net_item_amt", "discount_amt"],
                        "last_update", F.to_date(F.lit(STAMP)))


def menu_items_table(mart: Mart) -> DataFrame:
    """DOM-13: the menu items merged into their table on the id."""
    batch = reports.menu_items(mart)
    before = batch.filter("menu_item_id % 3 = 0").withColumn("menu_item", F.lit("old"))
    gone = batch.filter("menu_item_id % 7 = 0").withColumn("menu_item_id", -F.col("menu_item_id") - 1)
    return merge.upsert(before.unionByName(gone), batch, ["menu_item_id"])


def budget_table(mart: Mart) -> DataFrame:
    """DOM-16: the budget merged into its table; only the amount changes on a match."""
    batch = dims.budget_unpivot(mart)
    before = batch.filter("period % 2 = 0").withColumn("amount", F.lit(-1.0))
    older = batch.filter("period = 13").withColumn("year", F.col("year") - 100)
    return merge.upsert(before.unionByName(older), batch, ["location", "gl_number", "account_name", "year", "period"], ["amount"])


def weekly_cost_table(mart: Mart, year: int, period: int, week: int) -> DataFrame:
    """DOM-06: a week's costs merged into the table on (week, store, item); the week before stays.

    Both weeks come from one pass over the facts, written once: the merge reads its batch several times."""
    both = written(cost.weekly_item_base_cost(mart, year, period, week, weeks=2))
    last = fiscal_week_index(FISCAL_EPOCH, year, period, week)
    batch, before = both.filter(F.col("week_index") == last), both.filter(F.col("week_index") < last)
    stale = batch.filter("item_id % 3 = 0").withColumn("base_cost", F.lit(0.0))
    return merge.upsert(before.unionByName(stale), batch, ["week_index", "store_id", "item"])
