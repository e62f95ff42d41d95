"""Streaming catch-up over landed deliveries (INC-01, INC-02).

The feed is the ``orders`` table seen as sales lines that a point of sale sends
once a year. A line is sent the day after its business day under summary "a";
every third line is missing then. Every seventh is sent again two days later.
Days divisible by ten are corrected 40 days on under summary "b" (other lines
missing, amounts raised, every eleventh line booked to the next store), and
days divisible by twenty once more after 400 days under summary "c". So
corrections arrive in later deliveries than what they correct.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.session import scratch_path
from tavola.sources.mart import Mart
from tavola.streaming.incremental import current_rows, upsert_log

LINE = ["salesdetailid", "location", "date", "dailysalessummaryid"]
# Longer than any repeated delivery takes to arrive.
DELAY = "7 days"


def deliveries(mart: Mart) -> DataFrame:
    """Every line that is ever sent, with the time of sending."""
    o = mart.raw("orders")
    key = F.col("o_orderkey")
    lines = o.select(key.alias("salesdetailid"), (F.col("o_custkey") % 20).alias("location"),
                     F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("amount"))
    day = F.dayofmonth("date")

    def sent(rows: DataFrame, summary: str, after: int, factor: float) -> DataFrame:
        return rows.select("salesdetailid", "location", "date", F.lit(summary).alias("dailysalessummaryid"),
                           F.round(F.col("amount") * factor, 2).alias("amount"),
                           F.date_add("date", after).cast("timestamp").alias("sent"))

    first = sent(lines.filter("salesdetailid % 3 <> 0"), "a", 1, 1.0)
    again = first.filter("salesdetailid % 7 = 0").withColumn("sent", F.col("sent") + F.expr("INTERVAL 2 DAYS"))
    moved = lines.withColumn("location", F.expr("CASE WHEN salesdetailid % 11 = 0 THEN (location + 1) % 20 ELSE location END"))
    second = sent(moved.filter((day % 10 == 0) & (F.col("salesdetailid") % 3 != 1)), "b", 40, 1.1)
    third = sent(lines.filter((day % 20 == 0) & (F.col("salesdetailid") % 5 != 0)), "c", 400, 1.2)
    return first.unionByName(again).unionByName(second).unionByName(third)


def sales_stream(mart: Mart) -> DataFrame:
    """Land one delivery after the other and catch up after each; the table that results.

    Every catch-up run is a new start of the stream from its checkpoint, so its
    memory of repeated lines comes from the state store.
    """
    spark = mart.spark
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    sends = deliveries(mart).withColumn("delivery", F.year("sent"))
    bounds = sends.agg(F.min("delivery"), F.max("delivery")).first()
    schema = sends.drop("delivery").schema
    for year in range(bounds[0] or 0, (bounds[1] or -1) + 1):
        part = sends.filter(F.col("delivery") == year).drop("delivery")
        part.write.mode("append").parquet(f"{base}/landing")
        upsert_log(spark, f"{base}/landing", schema, f"{base}/log", f"{base}/checkpoint", LINE, "sent", DELAY).awaitTermination()
    log = spark.read.schema(schema).parquet(f"{base}/log") if bounds[0] else spark.createDataFrame([], schema)
    return current_rows(log, ["salesdetailid"], ["location", "date"], "dailysalessummaryid", "sent").select(*LINE, "amount")
