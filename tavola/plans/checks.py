"""Data-quality jobs over the invoice lines (DQ-01 .. DQ-05, DQ-08)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.operators.quality import null_report, read_checked, unmapped_report, write_checked
from tavola.session import scratch_path
from tavola.sources.mart import Mart

KEY = ["transactionid", "lineid"]


def invoice_lines(mart: Mart) -> DataFrame:
    """Invoice lines as landed: the quantity of every 25th is no number, line 7 is in a unit
    that no unit row has, and some keys repeat."""
    d = mart.transaction_detail
    written = F.when(F.col("quantity") % 25 == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string"))
    return d.select(*KEY, "itemid", F.col("unitofmeasurename").alias("uofm"), written.try_cast("double").alias("quantity"), "amount")


def checked_lines(mart: Mart) -> tuple[DataFrame, dict[str, int], str]:
    """Write the lines with all checks on the way: the lines, the counts and where they are."""
    lines = invoice_lines(mart)
    path = scratch_path(mart.spark, f"checked-{uuid.uuid4().hex}")
    counts = write_checked(lines, path, not_null=["quantity"], unique=KEY, mapped={"uofm": (mart.units, "name")}, allow_empty=True)
    return lines, counts, path


def check_counts(mart: Mart) -> DataFrame:
    """DQ-01/02/05/08: rows and rows with each problem, counted by the write itself."""
    _, counts, _ = checked_lines(mart)
    return mart.spark.createDataFrame(sorted(counts.items()), "problem string, n long")


def quarantined_lines(mart: Mart) -> DataFrame:
    """The lines that the write put aside, with what is wrong with them."""
    lines, _, path = checked_lines(mart)
    bad = read_checked(mart.spark, path, lines.schema, good=False)
    return bad.withColumn("problems", F.array_join(F.array_sort("problems"), ", "))


def accepted_totals(mart: Mart) -> DataFrame:
    """Number and amount of the accepted lines per unit."""
    lines, _, path = checked_lines(mart)
    good = read_checked(mart.spark, path, lines.schema)
    return good.groupBy("uofm").agg(F.count("*").alias("lines"), F.sum(F.col("amount").cast("decimal(20,2)")).cast("double").alias("amount"))


def null_lines(mart: Mart) -> DataFrame:
    """DQ-04: the lines with a null, before they are dropped."""
    return null_report(invoice_lines(mart))


def unmapped_units(mart: Mart) -> DataFrame:
    """DQ-05: unit names of the lines that the units do not hold."""
    return unmapped_report(invoice_lines(mart), "uofm", mart.units, "name")
