"""The data mart, derived from the driver's TPC-H-style tables.

Every mart table is a lazy DataFrame over the parquet inputs, so Catalyst
prunes columns and pushes filters into the scans of whatever a job finally
uses. Ids stay numeric (the source keys) - joining on ``bigint`` is cheaper
than on text and the results are the same.

Size notes for a large cluster:
  * ``transaction_detail`` (lineitem) and ``transaction`` (orders) are the
    facts; they are only ever shuffled on their join / group keys.
  * ``restaurants`` (supplier) and ``item`` (part) grow with the data, so they
    are *not* hinted for broadcast; Spark broadcasts them when its size
    estimate (and AQE's runtime size) is under the broadcast threshold.
  * ``units`` and ``glaccount`` have a fixed bound (6 rows, 3 rows) and are
    broadcast. Fiscal attributes are computed from each row's date, so no
    calendar bounds the facts; ``calendar`` itself spans the order dates.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.functions.util import case_map
from tavola.operators.calendar import FISCAL_NAMES, calendar_weeks, fiscal_columns

# ---------------------------------------------------------------------------
# The mapping of the test tables onto the mart.
# Units of measure: (uofm_id, name, base_uofm, base_qty).
UNITS = [
    (1, "Each", "Each", 1.0),
    (2, "OZ-wt", "OZ-wt", 1.0),
    (3, "OZ-fl", "OZ-fl", 1.0),
    (4, "LB", "OZ-wt", 16.0),
    (5, "Case-12", "Each", 12.0),
    (6, "Bin", "Each", 0.0),
]
# Line number of a lineitem -> unit name written on the invoice line
# ('Unmapped' has no unit row on purpose).
LINE_UNIT = {1: "Each", 2: "OZ-wt", 3: "OZ-fl", 4: "LB", 5: "Case-12",
             6: "Bin", 7: "Unmapped"}
# GL accounts: (glaccountid = l_returnflag, name).
GL_ACCOUNTS = [("R", "Beer"), ("A", "Liquor"), ("N", "Wine")]
# Order status -> transaction type.
TXN_TYPE = {"F": "AP Invoice", "O": "Stock Count", "P": "Waste Log"}
# Inventory item categories: p_size % 3 -> category1, p_type -> category2.
ITEM_CATEGORY1 = {0: "Food", 1: "LBW", 2: "Other"}
ITEM_CATEGORY2 = {"ECONOMY": "Beef", "SMALL": "Pork", "MEDIUM": "Seafood"}
ITEM_CATEGORY2_ELSE = "Food Other"
# Menu categories of the sales mix: p_type -> Cat2, p_size % 3 -> Cat1.
MENU_CATEGORY2 = {"ECONOMY": "Entree", "STANDARD": "Entree", "SMALL": "Appetizer",
                  "MEDIUM": "Dessert", "LARGE": "Salad", "PROMO": "Sides"}
MENU_CATEGORY1 = {0: "Food", 1: "Food", 2: "Beverage"}
CONCEPTS = ("Casual", "Steakhouse")       # even / odd store id
TIMEZONE = "America/New_York"
FISCAL_EPOCH = "1995-01-01"               # day 0 of the fiscal calendar
# ---------------------------------------------------------------------------

UNIT_SCHEMA = T.StructType([
    T.StructField("uofm_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("base_uofm", T.StringType(), False),
    T.StructField("base_qty", T.DoubleType(), False),
])
GL_SCHEMA = T.StructType([
    T.StructField("glaccountid", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
])


class Mart:
    """Lazily built mart tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    # -- raw inputs ---------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- fixed-size dimensions (safe to broadcast) ---------------------------
    @cached_property
    def units(self) -> DataFrame:
        return self.spark.createDataFrame(UNITS, UNIT_SCHEMA)

    @cached_property
    def glaccount(self) -> DataFrame:
        return self.spark.createDataFrame(GL_ACCOUNTS, GL_SCHEMA)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar_weeks(self.raw("orders"), "o_orderdate", FISCAL_EPOCH)

    # -- dimensions that grow with the data ----------------------------------
    @cached_property
    def restaurants(self) -> DataFrame:
        s = F.col("s_suppkey")
        hidden = (s % 10) == 9
        return self.raw("supplier").select(
            s.alias("id"),
            s.alias("locationid"),
            F.col("s_name").alias("name"),
            F.when(s % 2 == 0, F.lit(CONCEPTS[0])).otherwise(F.lit(CONCEPTS[1])).alias("concept"),
            F.lit(TIMEZONE).alias("timezone"),
            F.when(~hidden, F.concat(F.lit("T"), s.cast("string"))).alias("pos_store_id"),
            F.when(~hidden, F.concat(F.lit("store"), s.cast("string"), F.lit("@example.com"))).alias("email"),
        )

    @cached_property
    def item(self) -> DataFrame:
        p = F.col("p_partkey")
        return self.raw("part").select(
            p.alias("itemid"),
            F.concat_ws(" ", F.col("p_name"), p.cast("string")).alias("name"),
            case_map(F.col("p_size") % 3, ITEM_CATEGORY1).alias("category1"),
            case_map(F.col("p_type"), ITEM_CATEGORY2, ITEM_CATEGORY2_ELSE).alias("category2"),
            F.col("p_brand").alias("category3"),
        )

    @cached_property
    def item_conversion(self) -> DataFrame:
        p = F.col("p_partkey")
        size = F.col("p_size")
        return self.raw("part").select(
            p.alias("itemid"),
            F.concat_ws(" ", F.col("p_name"), p.cast("string")).alias("name"),
            (size % 5).cast("double").alias("weight_qty"),
            F.lit("OZ-wt").alias("weight_uofm"),
            (size % 4 + 1).cast("double").alias("volume_qty"),
            F.lit("OZ-fl").alias("volume_uofm"),
            (size % 3 + 1).cast("double").alias("each_qty"),
            F.lit("Each").alias("each_uofm"),
            case_map(size % 3, {0: "Weight", 1: "Volume", 2: "Each"}).alias("measure_type"),
        )

    # -- facts ----------------------------------------------------------------
    def transaction(self, *types: str) -> DataFrame:
        """Transaction headers, optionally only of some types (the filter is
        on the raw status code so it reaches the parquet scan)."""
        o = self.raw("orders")
        if types:
            inverse = {v: k for k, v in TXN_TYPE.items()}
            o = o.filter(F.col("o_orderstatus").isin([inverse[t] for t in types]))
        return o.select(
            F.col("o_orderkey").alias("transactionid"),
            F.col("o_orderdate").alias("date"),
            case_map(F.col("o_orderstatus"), TXN_TYPE).alias("type"),
        )

    @cached_property
    def transaction_detail(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("transactionid"),
            F.col("l_linenumber").alias("lineid"),
            F.col("l_suppkey").alias("locationid"),
            F.col("l_partkey").alias("itemid"),
            F.col("l_returnflag").alias("glaccountid"),
            case_map(F.col("l_linenumber"), LINE_UNIT).alias("unitofmeasurename"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("amount"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("previouscounttotal"),
            F.col("l_discount").alias("discount"),
        )

    def detail_rows(self, *types: str, pos_stores: bool = False) -> DataFrame:
        """Transaction lines of the given types joined to store, item, unit
        and account, with fiscal attributes of their date - the common body of
        ``purchases`` and ``stock_count``. ``pos_stores`` leaves out the stores
        without a point of sale, by a filter on the stores that are joined."""
        td = self.transaction_detail
        t = self.transaction(*types)
        r = self.restaurants.filter(F.col("pos_store_id").isNotNull()) if pos_stores else self.restaurants
        r = r.select(F.col("id"), F.col("locationid"), F.col("name").alias("store"))
        i = self.item.select("itemid", F.col("name").alias("item"), "category1", "category2")
        fiscal = [c for c, n in zip(fiscal_columns("date", FISCAL_EPOCH), FISCAL_NAMES)
                  if n in ("dow", "week", "period", "year", "week_index", "period_index")]
        um = self.units.select(F.col("name").alias("unitofmeasurename"), "base_uofm", "base_qty")
        gl = self.glaccount.select("glaccountid", F.col("name").alias("account"))
        return (td.join(t, "transactionid")
                  .join(r, "locationid")
                  .join(i, "itemid")
                  .withColumn("date", F.to_date("date"))
                  .select("*", *fiscal)
                  .join(F.broadcast(um), "unitofmeasurename", "left")
                  .join(F.broadcast(gl), "glaccountid", "left")
                  .withColumnRenamed("unitofmeasurename", "uofm"))

    @cached_property
    def purchases(self) -> DataFrame:
        return self.purchases_of()

    def purchases_of(self, pos_stores: bool = False) -> DataFrame:
        return self.detail_rows("AP Invoice", pos_stores=pos_stores).select(
            "transactionid", "lineid", "date", "dow", "week", "period", "year",
            "week_index", "period_index", "id", "store", "itemid", "item",
            "category1", "category2", "uofm", "quantity", "amount",
            "base_uofm", "base_qty", "discount")

    def stock_count(self, *types: str, pos_stores: bool = False) -> DataFrame:
        types = types or ("Stock Count", "Waste Log")
        return self.detail_rows(*types, pos_stores=pos_stores).select(
            "transactionid", "lineid", "date", "dow", "week", "period", "year",
            "week_index", "period_index", "id", "store", "type", "account",
            "itemid", "item", "category1", "category2", "uofm", "quantity",
            "amount", F.col("previouscounttotal").alias("previous_amount"),
            "base_uofm", "base_qty")

    @cached_property
    def inv_items(self) -> DataFrame:
        """Inventory-tracked (item, store) pairs: every Food item that a store
        has counted."""
        return (self.stock_count("Stock Count")
                .filter(F.col("category1") == "Food")
                .select(F.col("itemid").alias("id"), F.col("item").alias("item_name"),
                        F.col("id").alias("store_id"))
                .distinct())

    @cached_property
    def inv_count(self) -> DataFrame:
        return (self.stock_count("Stock Count")
                .groupBy(F.col("itemid").alias("item_id"), F.col("id").alias("store_id"),
                         F.col("date").alias("trans_date"))
                .agg(F.sum("quantity").alias("count_total")))

    # -- sales mix and recipe cost reports -----------------------------------
    @cached_property
    def product_mix(self) -> DataFrame:
        """Sales mix per store and menu item (quantity, unit price, sales) with
        the item's menu categories; categories are missing for every item
        whose size is a multiple of 11 (uncategorised items)."""
        return self.mix_and_cost.drop("cost")

    @cached_property
    def mix_and_cost(self) -> DataFrame:
        """The sales mix with the recipe cost of the pair, from one pass over the lines."""
        uncategorised = (F.col("p_size") % 11) == 0
        p = self.raw("part").select(
            F.col("p_partkey").alias("itemid"),
            F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("menu_item"),
            F.when(~uncategorised, case_map(F.col("p_size") % 3, MENU_CATEGORY1)).alias("cat1"),
            F.when(~uncategorised, case_map(F.col("p_type"), MENU_CATEGORY2, "Other")).alias("cat2"),
            F.when(~uncategorised, F.col("p_brand")).alias("cat3"))
        r = self.restaurants.select(F.col("id").alias("store_id"), F.col("name").alias("location"),
                                    "concept")
        return self._line_totals.join(p, "itemid").join(r, "store_id")

    @cached_property
    def menu_cost(self) -> DataFrame:
        """Recipe cost per store and menu item; null when no closed ('F')
        line exists for the pair."""
        return self._line_totals.select("store_id", "itemid", "cost")

    @cached_property
    def _line_totals(self) -> DataFrame:
        """Quantity, mean price, sales and recipe cost per store and item."""
        closed = F.col("l_linestatus") == "F"
        unit = F.try_divide(F.col("l_extendedprice") * (F.col("l_discount") + F.col("l_tax")),
                            F.col("l_quantity"))
        return (self.raw("lineitem")
                .groupBy(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("itemid"))
                .agg(F.sum("l_quantity").alias("qty"),
                     F.avg(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))).alias("price"),
                     F.sum("l_extendedprice").alias("sales"),
                     F.avg(F.when(closed, unit)).alias("cost")))
