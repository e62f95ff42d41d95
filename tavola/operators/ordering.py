"""Totally ordered results (SRT-01) without a task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.session import written

_LOCAL_BITS = 33  # of monotonically_increasing_id


def sort_keys(keys: Sequence) -> list[Column]:
    """``["a", ("b", "desc")]`` as sort columns; nulls come last either way."""
    out = []
    for k in keys:
        c, direction = k if isinstance(k, tuple) else (k, "asc")
        c = F.col(c) if isinstance(c, str) else c
        if direction not in ("asc", "desc"):
            raise ValueError(f"no sort direction: {direction}")
        out.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
    return out


def number_rows(df: DataFrame, keys: Sequence, name: str = "row_number", checkpoint: bool = True) -> DataFrame:
    """SRT-01: every row with its place (from 1) in the order of ``keys``.

    The rows are dealt to tasks by ranges of the keys and sorted there, counted
    per range, and each range's rows are numbered on from the rows before it: one
    number per range is all that is summed in one place. ``keys`` must order the
    rows fully for the numbers to be repeatable.
    """
    at = F.monotonically_increasing_id()
    placed = df.orderBy(*sort_keys(keys)).withColumn("_at", at)
    if checkpoint:
        placed = written(placed, tidy=True)
    placed = placed.withColumn("_range", F.shiftright("_at", _LOCAL_BITS))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))  # one row per range
    local = F.col("_at").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return (placed.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_before") + local + 1).drop("_range", "_before", "_at"))
