"""Fact feeds and dimension loads on the maintenance operators (DOM-19, 20, 22, 23).

Each job returns the new state of its table from the state before (rows up to
2000, older versions and names) and a landed batch (re-sent rows, nested
records). The rules that tell target and batch apart are over the given
tables' keys and dates, so both grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.nested import pick
from tavola.functions.strings import last_part, split_last, split_parts
from tavola.operators import merge
from tavola.operators.joins import validate_fk
from tavola.operators.recursive import materialise
from tavola.operators.unitgraph import SAME_FACTOR, resolve_units
from tavola.operators.windows import dedup
from tavola.plans.maintenance import BATCH_START, TARGET_END
from tavola.session import written
from tavola.sources.mart import GL_ACCOUNTS, TXN_TYPE, Mart
from tavola.functions.util import case_map


# -- DOM-22: fact feeds -----------------------------------------------------------
def transaction_feed(mart: Mart) -> DataFrame:
    """transaction: upsert on the id; the template is the last part of the
    transaction number (STR-03)."""
    day = F.to_date("o_orderdate")
    rows = mart.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("transactionId"), (F.col("o_custkey") % 100).cast("string").alias("locationId"),
        F.concat(F.lit("TX - "), "o_orderpriority", F.lit(" - "), F.col("o_orderkey").cast("string")).alias("transactionNumber"),
        F.col("o_custkey").cast("string").alias("companyId"), day.alias("date"), case_map(F.col("o_orderstatus"), TXN_TYPE).alias("type"))
    shape = [F.col("transactionId").alias("transactionid"), F.col("locationId").alias("locationid"),
             last_part("transactionNumber").alias("template"), F.col("companyId").alias("companyid"), "date", "type"]
    before = rows.filter(F.col("date") < F.lit(TARGET_END)).select(*shape).withColumn("type", F.lit("unposted"))
    return merge.upsert(before, rows.filter(F.col("date") >= F.lit(BATCH_START)).select(*shape), ["transactionid"])


def transaction_detail_feed(mart: Mart) -> DataFrame:
    """transaction_detail: the details of the day range's transactions replace
    that range (MRG-06); the date comes from the transaction (JN-01). The dated
    lines are joined and written once, for the table, the batch and its checks."""
    detail = mart.transaction_detail.select("transactionid", "lineid", "locationid", "itemid", "amount", "quantity")
    dates = mart.raw("orders").select(F.col("o_orderkey").alias("transactionid"), F.to_date("o_orderdate").alias("date"))
    dated = written(detail.join(dates.filter(F.col("date") < F.lit(TARGET_END)), "transactionid"))
    before = dated.withColumn("quantity", F.lit(0.0))
    return merge.replace_range(before, dated.filter(F.col("date") >= F.lit(BATCH_START)), "date", BATCH_START, TARGET_END)


def _versioned(target: DataFrame, batch: DataFrame, part: list[str], key: str) -> DataFrame:
    """Drop rows of other versions of the batch's parts (MRG-04), then replace
    the batch's keys (MRG-03)."""
    return merge.replace_keys(merge.drop_superseded_any(target, batch, part, "dailysalessummaryid"), batch, key)


def labor_detail_feed(mart: Mart) -> DataFrame:
    """labor_detail per event: a corrected day of a store removes the rows of
    its other versions."""
    rows = mart.raw("events").select(
        F.col("event_id").alias("laborid"), (F.col("user_id") % 20).alias("location_id"), F.to_date("ts").alias("dateworked"),
        F.col("event_type").alias("jobtitle"), F.round("value", 2).alias("total"))
    before = rows.filter(F.col("laborid") % 3 != 0).withColumn("dailysalessummaryid", F.when(F.col("laborid") % 11 != 0, F.lit("v1")))
    batch = rows.filter((F.col("laborid") % 5 == 0) & (F.col("location_id") < 10)).withColumn(
        "dailysalessummaryid", F.lit("v2")).withColumn("total", F.round(F.col("total") + 1, 2))
    return _versioned(before, batch, ["location_id", "dateworked"], "laborid")


def sales_detail_feed(mart: Mart) -> DataFrame:
    """sales_detail: versions absent from the batch go (MRG-05), then upsert on
    (id, date); the menu item is the second part of its name (STR-02)."""
    rows = mart.raw("orders").select(
        F.col("o_orderkey").alias("salesdetailid"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("location"),
        F.concat(F.lit("Menu - Item "), (F.col("o_custkey") % 50).cast("string"), F.lit(" - x")).alias("menuItem"),
        F.col("o_totalprice").alias("amount"))
    rows = rows.select(
        "salesdetailid", "date", "location", split_parts("menuItem", 2)[1].alias("menuitem"), "amount")
    before = rows.filter(F.col("date") < F.lit(TARGET_END)).withColumn("dailysalessummaryid", F.concat(F.lit("v"), (F.col("salesdetailid") % 3).cast("string")))
    batch = rows.filter(F.col("date") >= F.lit(BATCH_START)).withColumn("dailysalessummaryid", F.concat(F.lit("v"), (F.col("salesdetailid") % 2).cast("string")))
    kept = merge.drop_superseded_absent(before, batch, ["date", "location"], "dailysalessummaryid")
    return merge.upsert(kept, batch, ["salesdetailid", "date"])


def _summaries(mart: Mart, kind: str, key: str) -> tuple[DataFrame, DataFrame]:
    rows = mart.raw("events").filter(F.col("event_type") == kind).select(
        F.col("event_id").alias(key), (F.col("user_id") % 20).alias("location"), F.to_date("ts").alias("date"),
        F.round("value", 2).alias("amount"))
    before = rows.filter(F.col(key) % 2 == 0).withColumn("dailysalessummaryid", F.lit("a"))
    batch = rows.filter(F.col(key) % 3 == 0).withColumn("dailysalessummaryid", F.when(F.col("location") % 4 == 0, F.lit("a")).otherwise(F.lit("b")))
    return before, batch


def sales_employee_feed(mart: Mart) -> DataFrame:
    before, batch = _summaries(mart, "click", "salesid")
    return _versioned(before, batch, ["location", "date"], "salesid")


def sales_payment_feed(mart: Mart) -> DataFrame:
    before, batch = _summaries(mart, "purchase", "salespaymentid")
    return _versioned(before, batch, ["location", "date"], "salespaymentid")


def dss_list(mart: Mart) -> DataFrame:
    """DOM-23: distinct day, summary, store and payment of the payment feed."""
    return sales_payment_feed(mart).select("date", "dailysalessummaryid", "location", "salespaymentid").distinct()


# -- DOM-19/20: dimensions from nested records ----------------------------------------
def landed(df: DataFrame, record, schema: str) -> DataFrame:
    """Records as they land: JSON text, parsed with an explicit schema."""
    return df.select(F.to_json(record).alias("j")).select(F.from_json("j", schema).alias("r")).select("r.*")


def job_titles(mart: Mart) -> DataFrame:
    """job_title: a GL account that does not exist becomes null (JN-17)."""
    nation = mart.raw("nation")
    rec = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                   F.when(F.col("n_nationkey") % 4 != 3, F.struct((F.col("n_regionkey") * 2).alias("id"))).alias("glAccount"))
    batch = pick(landed(nation, rec, "id long, name string, glAccount struct<id: long>"),
                 {"job_title_id": "id", "name": "name", "glaccountid": "glAccount.id"})
    accounts = mart.raw("region").select(F.col("r_regionkey").alias("glaccountid"))
    batch = validate_fk(batch, "glaccountid", accounts, "glaccountid")
    batch = batch.withColumn("glaccountid", F.col("glaccountid").cast("string"))
    before = nation.filter(F.col("n_nationkey") < 12).select(F.col("n_nationkey").alias("job_title_id"), F.lit("old").alias("name"),
                                                            F.lit(None).cast("string").alias("glaccountid"))
    return merge.upsert(before, batch, ["job_title_id"])


def sales_accounts(mart: Mart) -> DataFrame:
    """sales_accounts: service type and day part split at the last dash (STR-04),
    GL account by name from a nested record; repeated accounts count once."""
    part = mart.raw("part")
    label = F.when(F.col("p_size") % 5 == 0, F.col("p_type")).otherwise(
        F.concat("p_type", F.lit(" - "), F.col("p_brand"), F.lit(" - "), F.when(F.col("p_size") % 2 == 0, F.lit("Lunch")).otherwise(F.lit("Dinner"))))
    name = F.concat_ws("/", "p_brand", "p_type")
    rec = F.struct(name.alias("id"), name.alias("name"), label.alias("serviceType"),
                   F.when(F.col("p_size") % 3 != 0, F.struct(F.element_at(F.array(*[F.lit(n) for _, n in GL_ACCOUNTS]), (F.col("p_size") % 3).cast("int")).alias("name")))
                    .alias("glAccount"), F.col("p_partkey").alias("seq"))
    rows = pick(landed(part, rec, "id string, name string, serviceType string, glAccount struct<name: string>, seq long"),
                {"sales_account_id": "id", "name": "name", "kind": "serviceType", "gl_account": "glAccount.name", "seq": "seq"})
    service, day_part = split_last("kind")
    rows = rows.select("sales_account_id", "name", service.alias("service_type"), day_part.alias("day_part"), "gl_account", "seq")
    batch = dedup(rows, ["sales_account_id"], ["seq"], keep="last").drop("seq")
    before = batch.filter(F.col("name").like("Brand#1%")).withColumn("service_type", F.lit("old"))
    return merge.upsert(before, batch, ["sales_account_id"])


def purchase_items(mart: Mart) -> DataFrame:
    """purchase_item: nested names of categories and units, null where the
    object is missing (NST-01); only some columns are updated on a match."""
    part = mart.raw("part")
    p = F.col("p_partkey")
    rec = F.struct(p.alias("id"), F.concat_ws(" ", "p_name", p.cast("string")).alias("name"),
                   F.when(F.col("p_size") % 7 != 0, F.struct(F.col("p_type").alias("name"))).alias("itemCategory1"),
                   F.when(F.col("p_size") % 6 != 0, F.struct(F.col("p_brand").alias("name"))).alias("itemCategory2"),
                   (F.col("p_size") % 2 == 0).alias("isKeyItem"))
    batch = pick(landed(part, rec, "id long, name string, itemCategory1 struct<name: string>, itemCategory2 struct<name: string>, isKeyItem boolean"),
                 {"item_id": "id", "name": "name", "category1": "itemCategory1.name", "category2": "itemCategory2.name", "key_item": "isKeyItem"})
    before = part.filter(p % 3 == 0).select(p.alias("item_id"), F.lit("old").alias("name"), F.lit("kept").alias("category1"),
                                            F.lit("old").alias("category2"), F.lit(False).alias("key_item"))
    return merge.upsert(before, batch, ["item_id"], update_cols=["name", "category2", "key_item"])


# -- DOM-20: units of measure -----------------------------------------------------------
# Base units, and the measure type of each.
BASE_UNITS = {"Each": "Each", "OZ-wt": "Weight", "OZ-fl": "Volume"}


def landed_units(mart: Mart) -> DataFrame:
    """Unit records, one per part k and one per base unit.

    Unit k is (k % 3 + 2) of unit k // 4, units up to 3 are that many of a base
    unit. Units 50, 150, .. and their successors are defined by each other
    (without contradiction for 50, 250, ..), units 75, 175, .. by nothing, 85,
    185, .. with quantity 0 and 95, 195, .. by an unknown unit. Units up to 3 and
    their multiples by four, plus every 37th unit (wrongly), also state how much
    of which base they are.
    """
    k = F.col("p_partkey")
    first = mart.raw("part").select("p_partkey").distinct()
    def base(n):
        return F.element_at(F.array(*map(F.lit, BASE_UNITS)), (n % 3 + 1).cast("int"))
    rest = k % 100
    other = (F.when(k <= 3, base(k)).when(rest == 50, F.concat(F.lit("U"), (k + 1).cast("string")))
             .when(rest == 51, F.concat(F.lit("U"), (k - 1).cast("string"))).when(rest == 75, F.lit(None).cast("string"))
             .when(rest == 95, F.lit("Unheard")).otherwise(F.concat(F.lit("U"), F.floor(k / 4).cast("long").cast("string"))))
    qty = (F.when(rest == 50, 4.0).when(rest == 51, F.when((k - 1) % 200 == 50, 0.25).otherwise(0.5)).when(rest == 85, 0.0)
           .otherwise((k % 3 + 2).cast("double")))
    stated = F.when(k <= 3, k % 3 + 2).when((k % 4 == 0) & (k <= 12), (k % 3 + 2) * (k / 4 % 3 + 2)).when(k % 37 == 0, F.lit(1))
    stated_base = F.when(k <= 3, base(k)).when((k % 4 == 0) & (k <= 12), base(F.floor(k / 4))) \
                   .when(k % 37 == 0, F.lit("Each"))
    def named(c):
        return F.when(c.isNotNull(), F.struct(c.alias("name")))
    made = first.select(F.struct(
        k.alias("id"), F.concat(F.lit("U"), k.cast("string")).alias("name"), qty.alias("equivalentQuantity"),
        named(other).alias("equivalentUnitOfMeasure"),
        F.element_at(F.array(*map(F.lit, BASE_UNITS.values())), (k % 3 + 1).cast("int")).alias("measureType"),
        named(stated_base).alias("baseUnitOfMeasure"), stated.cast("double").alias("baseQuantity"), (k % 9 != 0).alias("isActive")).alias("r"))
    units = mart.spark.createDataFrame([(-i - 1, b, t) for i, (b, t) in enumerate(BASE_UNITS.items())], "id long, name string, kind string")
    roots = units.select(F.struct(
        "id", "name", F.lit(1.0).alias("equivalentQuantity"), named(F.lit(None).cast("string")).alias("equivalentUnitOfMeasure"),
        F.col("kind").alias("measureType"), named(F.col("name")).alias("baseUnitOfMeasure"), F.lit(1.0).alias("baseQuantity"),
        F.lit(True).alias("isActive")).alias("r"))
    return made.unionByName(roots).select(F.to_json("r").alias("j"))


UNIT_RECORD = ("id long, name string, equivalentQuantity double, equivalentUnitOfMeasure struct<name: string>, measureType string, "
               "baseUnitOfMeasure struct<name: string>, baseQuantity double, isActive boolean")


def units_table(mart: Mart) -> DataFrame:
    """unitsofmeasure, all eight columns: upsert of the landed records on the id."""
    batch = pick(landed_units(mart).select(F.from_json("j", UNIT_RECORD).alias("r")).select("r.*"), {
        "uofm_id": "id", "name": "name", "equivalent_qty": "equivalentQuantity", "equivalent_uofm": "equivalentUnitOfMeasure.name",
        "measure_type": "measureType", "base_uofm": "baseUnitOfMeasure.name", "base_qty": "baseQuantity", "active": "isActive"})
    old = batch.filter("uofm_id % 3 = 0").withColumn("equivalent_qty", F.lit(-1.0)).withColumn("active", F.lit(False))
    return merge.upsert(old, batch, ["uofm_id"])


def units(mart: Mart, checkpoint: bool = True) -> DataFrame:
    """The units with their factor to a base unit, and what is wrong with the others.

    ``stated_ok`` compares the base and quantity that a record states with those
    that its definition leads to (null where either is missing).
    """
    table = materialise(units_table(mart), checkpoint)
    bases = table.filter(F.col("name").isin(*BASE_UNITS)).select(F.col("name").alias("unit"))
    edges = table.select(F.col("name").alias("unit"), F.col("equivalent_uofm").alias("other"), F.col("equivalent_qty").alias("qty"))
    found = resolve_units(edges, bases, checkpoint).withColumnRenamed("unit", "name").withColumnRenamed("base", "root")
    same = (F.col("base_uofm") == F.col("root")) & (F.abs(F.log(F.col("base_qty") / F.col("factor"))) <= SAME_FACTOR)
    return (table.join(found, "name").withColumn("stated_ok", same)
            .withColumn("loop_factor", F.round("loop_factor", 9)))
