"""Keeping mart tables current (DOM-19..23 building blocks on a sales feed).

The feed is the ``orders`` table seen as daily sales lines: key
``salesdetailid``, partition (location, date), a summary ``version``.
``feed_target`` is the table as loaded before 2000; ``feed_batch`` is a feed
re-sending everything from July 1999 on with corrected amounts and, per
line, version v1 or v2 - so the overlapping half-year carries superseded
versions, and some target rows have no version at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.operators import merge
from tavola.operators.joins import find_renamed, validate_fk
from tavola.operators.quality import duplicate_report
from tavola.operators.windows import dedup
from tavola.sources.mart import Mart

TARGET_END = "2000-01-01"
BATCH_START = "1999-07-01"
STAMP = "2001-08-01"


def sales_feed(mart: Mart) -> DataFrame:
    return mart.raw("orders").select(
        F.col("o_orderkey").alias("salesdetailid"),
        F.col("o_orderpriority").alias("location"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("amount"))


def feed_target(mart: Mart) -> DataFrame:
    return (sales_feed(mart).filter(F.col("date") < F.lit(TARGET_END))
            .withColumn("version", F.when(F.col("customer") % 50 != 0, F.lit("v1")))
            .withColumn("last_update", F.to_date(F.lit(TARGET_END))))


def feed_batch(mart: Mart) -> DataFrame:
    return (sales_feed(mart).filter(F.col("date") >= F.lit(BATCH_START))
            .withColumn("amount", F.round(F.col("amount") * 1.1, 2))
            .withColumn("version", F.concat(F.lit("v"), (F.col("salesdetailid") % 2 + 1).cast("string"))))


KEY = ["salesdetailid"]
PART = ["location", "date"]


def upsert_full(mart: Mart) -> DataFrame:
    return merge.upsert(feed_target(mart), feed_batch(mart), KEY)


def upsert_subset(mart: Mart) -> DataFrame:
    return merge.upsert(feed_target(mart), feed_batch(mart), KEY,
                        update_cols=["amount", "version"], stamp_col="last_update",
                        stamp=F.to_date(F.lit(STAMP)))


def replace_keys(mart: Mart) -> DataFrame:
    return merge.replace_keys(feed_target(mart), feed_batch(mart), "date")


def drop_superseded_any(mart: Mart) -> DataFrame:
    return merge.drop_superseded_any(feed_target(mart), feed_batch(mart), PART, "version")


def drop_superseded_absent(mart: Mart) -> DataFrame:
    return merge.drop_superseded_absent(feed_target(mart), feed_batch(mart), PART, "version")


def replace_range(mart: Mart) -> DataFrame:
    """The batch is the feed's download of the range that is replaced."""
    batch = feed_batch(mart).filter((F.col("date") >= F.lit(BATCH_START)) & (F.col("date") < F.lit(TARGET_END)))
    return merge.replace_range(feed_target(mart), batch, "date", BATCH_START, TARGET_END)


def replace_year(mart: Mart) -> DataFrame:
    return merge.replace_partitions(feed_target(mart), feed_batch(mart), F.year("date"))


def sync_full(mart: Mart) -> DataFrame:
    return merge.sync(feed_target(mart), feed_batch(mart), KEY)


# -- snapshot diff and rename propagation (JN-18, MRG-09, INC-04) -----------
def customer_snapshots(mart: Mart) -> tuple[DataFrame, DataFrame]:
    """Old snapshot = customer table; new snapshot renames customers with a
    negative balance (marked closed)."""
    old = mart.raw("customer").select("c_custkey", "c_name", "c_acctbal")
    new = old.withColumn("c_name", F.when(F.col("c_acctbal") < 0,
                                          F.concat(F.col("c_name"), F.lit(" (closed)")))
                                    .otherwise(F.col("c_name")))
    return old, new


def renamed_customers(mart: Mart) -> DataFrame:
    old, new = customer_snapshots(mart)
    return find_renamed(old, new, "c_custkey", "c_name")


def orders_with_renames(mart: Mart) -> DataFrame:
    """Fact rows carrying the customer name, with renames applied by name."""
    old, _ = customer_snapshots(mart)
    fact = (mart.raw("orders").select("o_orderkey", "o_custkey")
            .join(old.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("cust_name")),
                  "o_custkey"))
    mapping = renamed_customers(mart).select(F.col("old_c_name").alias("old"),
                                             F.col("new_c_name").alias("new"))
    return merge.apply_renames(fact, mapping, "cust_name")


# -- de-duplication and checks ------------------------------------------------
def events_dedup(mart: Mart, keep: str) -> DataFrame:
    """AGG-13: one event per user, the last (or first) by time then id."""
    ev = mart.raw("events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedup(ev, ["user_id"], ["ts", "event_id"], keep=keep)


def orders_fk_validated(mart: Mart) -> DataFrame:
    """JN-17: customer ids kept only when the customer is active (balance
    not negative), else nulled."""
    active = mart.raw("customer").filter(F.col("c_acctbal") >= 0)
    o = mart.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = validate_fk(o, "o_custkey", active, "c_custkey")
    # A nullable id column is rendered as text so every client reads the same
    # values (pandas would turn a nullable bigint into floats).
    return out.withColumn("o_custkey", F.col("o_custkey").cast("string"))


def lineitem_duplicates(mart: Mart) -> DataFrame:
    """DQ-03: every line whose (order, line number) occurs more than once."""
    li = mart.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                     "l_quantity")
    return duplicate_report(li, ["l_orderkey", "l_linenumber"])
