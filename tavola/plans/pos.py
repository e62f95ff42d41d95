"""Point-of-sale jobs over landed JSON: payments and product mix (DOM-11/12).

The landed documents are built from the ``events`` table (one order and one
payment document per event, so no group is ever gathered into one row):
an event is a check selection of menu item ``k`` (``props.k``) priced at
``value``; errors are voided, sign-ups carry no item, every fifth item is
rung with quantity 0, purchases carry a 10 % discount; items with ``k``
divisible by 3 have a size modifier (with a nested "Extra" modifier), which
replaces the price when ``k`` is even, and every third of these a second
modifier "Side"; every seventh item is rung again, twice, on a second check of
the order; every nineteenth is an allergy note and no item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.functions.dates import yyyymmdd_to_date
from tavola.functions.nested import flatten
from tavola.operators.aggregates import any_element, sum_array
from tavola.operators.filters import not_in, remove_special
from tavola.operators.recursive import explode_levels, materialise
from tavola.operators.windows import dedup
from tavola.sources.mart import Mart

# Card entry modes; the six the payment report leaves out.
CARD_ENTRY_MODES = ["SWIPED", "EMV_CHIP_SIGN", "ONLINE", "SAVED_CARD", "PRE_AUTHED",
                    "FUTURE_ORDER", "INCREMENTAL_PRE_AUTHED"]
EXCLUDED_ENTRY_MODES = ["EMV_CHIP_SIGN", "ONLINE", "SAVED_CARD", "PRE_AUTHED", "FUTURE_ORDER",
                        "INCREMENTAL_PRE_AUTHED"]
REPLACES_PRICE = "REPLACES_PRICE"


def _events(mart: Mart) -> DataFrame:
    return (mart.raw("events")
            .withColumn("k", F.get_json_object("props", "$.k").cast("long"))
            .withColumn("bdate", F.to_date("ts")))


# -- landed documents -----------------------------------------------------------
def landed_payments(mart: Mart) -> DataFrame:
    """Payment documents (one JSON text per payment) with nested server and
    device objects."""
    e = _events(mart)
    mode = F.element_at(F.array(*[F.lit(m) for m in CARD_ENTRY_MODES]), (F.col("k") % 7 + 1).cast("int"))
    doc = F.struct(
        F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("guid"),
        F.when(F.col("event_type") == "purchase", F.lit("CREDIT")).otherwise(F.lit("CASH")).alias("type"),
        F.when(F.col("k") % 13 != 0, mode).alias("cardEntryMode"),
        F.col("value").alias("amount"),
        F.round(F.col("value") * 0.15, 2).alias("tipAmount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("paidDate"),
        F.concat(F.lit("Store "), (F.col("user_id") % 20).cast("string")).alias("location_name"),
        F.struct(F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")).alias("guid")).alias("server"),
        F.struct(F.concat(F.lit("d"), (F.col("user_id") % 3).cast("string")).alias("id"))
         .alias("lastModifiedDevice"))
    return e.select(F.to_json(doc).alias("json"))


PAYMENT_SCHEMA = T.StructType([
    T.StructField("guid", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("cardEntryMode", T.StringType()), T.StructField("amount", T.DoubleType()),
    T.StructField("tipAmount", T.DoubleType()), T.StructField("paidDate", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("server", T.StructType([T.StructField("guid", T.StringType())])),
    T.StructField("lastModifiedDevice", T.StructType([T.StructField("id", T.StringType())])),
])


def payment_report(mart: Mart) -> DataFrame:
    """DOM-12: credit payments, flattened, without the six excluded entry
    modes (a payment without an entry mode is kept, as in pandas)."""
    p = landed_payments(mart).select(F.from_json("json", PAYMENT_SCHEMA).alias("p")).select("p.*")
    flat = flatten(p)
    credit = flat.filter(F.col("type") == "CREDIT")
    return not_in(credit, "cardEntryMode", EXCLUDED_ENTRY_MODES, keep_null=True)


def payment_summary(mart: Mart) -> DataFrame:
    """DOM-12 / AGG-03: total and count of amounts per location and entry
    mode (rows without an entry mode drop out of the grouping, as in
    pandas)."""
    r = payment_report(mart).filter(F.col("cardEntryMode").isNotNull())
    return (r.groupBy("location_name", "cardEntryMode")
             .agg(F.round(F.sum("amount"), 2).alias("total_amount"), F.count("amount").alias("count")))


def _selection(e) -> F.Column:
    k = F.col("k")
    nested = F.struct(
        F.concat(F.lit("Extra "), k.cast("string")).alias("displayName"),
        F.struct(F.concat(F.lit("n"), k.cast("string")).alias("guid")).alias("item"),
        F.lit(1).alias("quantity"), F.lit(0.5).alias("receiptLinePrice"),
        F.lit(0.5).alias("preDiscountPrice"), F.lit(0.5).alias("price"),
        F.lit("ADJUSTS_PRICE").alias("optionGroupPricingMode"),
        F.array().cast("array<struct<discountAmount:double>>").alias("appliedDiscounts"),
        F.array().cast("array<string>").alias("modifiers"))
    half = F.round(F.col("value") / 2, 2)
    size = F.struct(
        F.concat(F.lit("Size "), (k % 4).cast("string")).alias("displayName"),
        F.struct(F.concat(F.lit("m"), k.cast("string")).alias("guid")).alias("item"),
        F.lit(1).alias("quantity"), half.alias("receiptLinePrice"), half.alias("preDiscountPrice"),
        half.alias("price"),
        F.when(k % 2 == 0, F.lit(REPLACES_PRICE)).otherwise(F.lit("ADJUSTS_PRICE"))
         .alias("optionGroupPricingMode"),
        F.array().cast("array<struct<discountAmount:double>>").alias("appliedDiscounts"),
        F.array(nested).alias("modifiers"))
    side = F.struct(
        F.lit("Side").alias("displayName"),
        F.struct(F.concat(F.lit("s"), k.cast("string")).alias("guid")).alias("item"),
        F.lit(1).alias("quantity"), F.lit(0.25).alias("receiptLinePrice"), F.lit(0.25).alias("preDiscountPrice"),
        F.lit(0.25).alias("price"), F.lit("ADJUSTS_PRICE").alias("optionGroupPricingMode"),
        F.array().cast("array<struct<discountAmount:double>>").alias("appliedDiscounts"),
        F.filter(F.array(nested), lambda _: F.lit(False)).alias("modifiers"))
    discounts = F.when(F.col("event_type") == "purchase",
                       F.array(F.struct(F.round(F.col("value") * 0.1, 2).alias("discountAmount")))) \
                 .otherwise(F.array().cast("array<struct<discountAmount:double>>"))
    return F.struct(
        F.concat(F.lit("Item "), k.cast("string"), F.when(k % 19 == 0, F.lit(" Allergy")).otherwise(F.lit("")))
         .alias("displayName"),
        F.when(F.col("event_type") != "signup",
               F.struct(F.concat(F.lit("g"), k.cast("string")).alias("guid"))).alias("item"),
        F.when(k % 5 == 0, F.lit(0)).otherwise(F.lit(1)).alias("quantity"),
        F.col("value").alias("receiptLinePrice"), F.col("value").alias("preDiscountPrice"),
        F.col("value").alias("price"),
        (F.col("event_type") == "error").alias("voided"),
        discounts.alias("appliedDiscounts"),
        F.when(k % 9 == 0, F.array(size, side)).when(k % 3 == 0, F.array(size)).alias("modifiers"))


def landed_orders(mart: Mart) -> DataFrame:
    """Order documents: businessDate (yyyyMMdd) and checks[selections[...]]
    with modifiers nested inside modifiers."""
    e = _events(mart)
    sel = _selection(e)
    check = F.struct(F.array(sel).alias("selections"))
    again = F.struct(F.array(sel, sel).alias("selections"))
    doc = F.struct(F.date_format("bdate", "yyyyMMdd").cast("int").alias("businessDate"),
                   (F.col("user_id") % 20).alias("store_id"),
                   F.when(F.col("k") % 7 == 0, F.array(check, again)).otherwise(F.array(check)).alias("checks"))
    return e.select(F.to_json(doc).alias("json"))


DISCOUNTS = T.ArrayType(T.StructType([T.StructField("discountAmount", T.DoubleType())]))
ITEM = T.StructType([T.StructField("guid", T.StringType())])
LINE_FIELDS = [
    T.StructField("displayName", T.StringType()), T.StructField("item", ITEM),
    T.StructField("quantity", T.DoubleType()), T.StructField("receiptLinePrice", T.DoubleType()),
    T.StructField("preDiscountPrice", T.DoubleType()), T.StructField("price", T.DoubleType()),
    T.StructField("appliedDiscounts", DISCOUNTS),
    # a variant: the modifier tree has no fixed depth
    T.StructField("modifiers", T.VariantType()),
]
SELECTION_SCHEMA = T.StructType(LINE_FIELDS + [T.StructField("voided", T.BooleanType())])
ORDER_SCHEMA = T.StructType([
    T.StructField("businessDate", T.IntegerType()), T.StructField("store_id", T.LongType()),
    T.StructField("checks", T.ArrayType(T.StructType([
        T.StructField("selections", T.ArrayType(SELECTION_SCHEMA))]))),
])
ROW_COLS = ["item_guid", "date", "store_id", "item_name", "qty", "menu", "gross", "net", "discount"]


def _zero(c) -> F.Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def _list(c) -> F.Column:
    """The elements of a variant list; null for anything else."""
    return F.try_variant_get(c, "$", "array<variant>")


def _modifier(m) -> list[F.Column]:
    """The fields of a modifier; a value of another type is null."""
    def get(path: str, kind: str) -> F.Column:
        return F.try_variant_get(m, f"$.{path}", kind)
    return [get("displayName", "string").alias("displayName"), F.struct(get("item.guid", "string").alias("guid")).alias("item"),
            *[get(c, "double").alias(c) for c in ("quantity", "receiptLinePrice", "preDiscountPrice", "price")],
            get("appliedDiscounts", "array<struct<discountAmount:double>>").alias("appliedDiscounts"),
            get("optionGroupPricingMode", "string").alias("optionGroupPricingMode"), get("modifiers", "variant").alias("modifiers")]


def selections(orders_json: DataFrame) -> DataFrame:
    """NST-03 / FLT-15: orders -> checks -> selections, without voided
    selections and selections without an item."""
    o = orders_json.select(F.from_json("json", ORDER_SCHEMA).alias("o")).select("o.*")
    checks = o.select(yyyymmdd_to_date("businessDate").alias("date"), "store_id",
                      F.explode("checks").alias("c"))
    sel = checks.select("date", "store_id", F.explode("c.selections").alias("s")).select(
        "date", "store_id", "s.*")
    return (sel.filter(~F.coalesce(F.col("voided"), F.lit(False)))
               .filter(F.col("item.guid").isNotNull())
               .withColumn("mods", F.transform(_list("modifiers"), lambda m: F.struct(*_modifier(m))))
               .withColumn("discount", sum_array("appliedDiscounts", "discountAmount"))
               .withColumn("size_priced", any_element(
                   "mods", lambda m: m["optionGroupPricingMode"] == F.lit(REPLACES_PRICE))))


def _modifier_level(level: DataFrame) -> DataFrame:
    """One modifier level: each element of the ``modifiers`` list, taken apart;
    modifiers without an item are dropped together with their children."""
    return (level.select("date", "store_id", F.explode(_list("modifiers")).alias("m"))
                 .select("date", "store_id", *_modifier(F.col("m")))
                 .filter(F.col("item.guid").isNotNull()))


def product_mix_rows(mart: Mart, checkpoint: bool = True) -> DataFrame:
    """NST-04/05 + REC-03: sale rows of items and modifiers.

    Size-priced selections (any modifier replaces the price) emit only their
    priced modifiers, named "item modifier", at gross / quantity, carrying
    the selection's discount; other selections emit themselves and every
    modifier at any depth. The orders are read and parsed once, modifiers into a
    VARIANT: their selections are checkpointed, and the three kinds of rows start
    from them.
    """
    sel = materialise(selections(landed_orders(mart)), checkpoint)
    size_rows = (sel.filter("size_priced")
                    .select("date", "store_id", F.col("displayName").alias("sel_name"), "discount",
                            F.explode("mods").alias("m"))
                    .filter((_zero("m.price") != 0) & F.col("m.item.guid").isNotNull() &
                            (_zero("m.quantity") != 0))
                    .select(F.col("m.item.guid").alias("item_guid"), "date", "store_id",
                            F.concat_ws(" ", "sel_name", "m.displayName").alias("item_name"),
                            F.col("m.quantity").alias("qty"),
                            (_zero("m.preDiscountPrice") / F.col("m.quantity")).alias("menu"),
                            _zero("m.preDiscountPrice").alias("gross"), _zero("m.price").alias("net"),
                            "discount"))
    plain = sel.filter(~F.col("size_priced"))
    item_rows = plain.select(F.col("item.guid").alias("item_guid"), "date", "store_id",
                             F.coalesce("displayName", F.lit("Unknown Item")).alias("item_name"),
                             _zero("quantity").alias("qty"), _zero("receiptLinePrice").alias("menu"),
                             _zero("preDiscountPrice").alias("gross"), _zero("price").alias("net"),
                             "discount")

    def emit(level: DataFrame) -> DataFrame:
        return level.select(
            F.col("item.guid").alias("item_guid"), "date", "store_id",
            F.coalesce("displayName", F.lit("Unknown Modifier")).alias("item_name"),
            _zero("quantity").alias("qty"), _zero("receiptLinePrice").alias("menu"),
            _zero("preDiscountPrice").alias("gross"), _zero("price").alias("net"),
            sum_array("appliedDiscounts", "discountAmount").alias("discount"))

    more = F.size(_list("modifiers")) > 0
    mod_rows = explode_levels(_modifier_level(plain.filter(more)), _modifier_level, emit, more, checkpoint)
    return item_rows.unionByName(size_rows).unionByName(mod_rows.select(*ROW_COLS))


def product_mix(mart: Mart, exclusions: DataFrame | None = None) -> DataFrame:
    """DOM-11 / AGG-02: per item, business day and store: quantity sold,
    unweighted mean menu price, gross, net and discount totals. Excluded names
    and notes are left out; an item sold under several names on a day is one
    row, the last by name."""
    rows = remove_special(product_mix_rows(mart), "item_name", exclusions)
    named = (rows.groupBy("item_guid", "date", "store_id", "item_name")
                .agg(F.round(F.sum("qty"), 4).alias("qty_sold"),
                     F.round(F.avg("menu"), 4).alias("menu_item_price"),
                     F.round(F.sum("gross"), 4).alias("gross_item_amt"),
                     F.round(F.sum("net"), 4).alias("net_item_amt"),
                     F.round(F.sum("discount"), 4).alias("discount_amt")))
    return dedup(named, ["item_guid", "date", "store_id"], ["item_name"], keep="last")
