"""Aggregation helpers (AGG-01..16).

All of them are ``groupBy().agg()`` plans, so Spark aggregates partially on
the map side before the shuffle: a hot key costs one partial row per input
partition, not a third of the table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.functions.util import as_col

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def sum_numeric(df: DataFrame, keys: Sequence[str], null_as_zero: bool = True) -> DataFrame:
    """AGG-04: sum every numeric column per key (pandas ``sum``: an all-null
    group sums to 0)."""
    cols = numeric_columns(df, keys)
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) if null_as_zero else F.sum(c).alias(c)
            for c in cols]
    return df.groupBy(*keys).agg(*aggs)


def mean_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-05: mean of every numeric column per key (nulls skipped)."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numeric_columns(df, keys)])


def conditional_sum(value, cond) -> Column:
    """AGG-07: ``sum(value where cond)``, 0 when nothing matches."""
    return F.coalesce(F.sum(F.when(as_col(cond), as_col(value))), F.lit(0.0))


def with_totals(df: DataFrame, group: Sequence[str], measures: Sequence[str],
                ratios: dict[str, tuple[str, str, float]] | None = None,
                label_col: str = "row_type", label: str = "Total",
                detail_label: str = "item") -> DataFrame:
    """AGG-08: detail rows plus one totals row per ``group`` with the sums of
    ``measures``; each ratio ``name -> (num, den, default)`` is recomputed
    from the totals (``num/den`` if ``den`` is non-zero, else ``default``).

    The totals come from a ``groupBy`` (partial aggregation), so the detail
    is never gathered per group.
    """
    ratios = ratios or {}
    # pandas semantics: a sum skips nulls and an all-null sum is 0.
    totals = df.groupBy(*group).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    for name, (num, den, default) in ratios.items():
        totals = totals.withColumn(
            name, F.when(F.coalesce(F.col(den), F.lit(0)) != 0, F.col(num) / F.col(den))
                   .otherwise(F.lit(float(default))))
    detail = df.withColumn(label_col, F.lit(detail_label))
    totals = totals.withColumn(label_col, F.lit(label))
    return detail.unionByName(totals, allowMissingColumns=True)


def pivot_margins(df: DataFrame, index: str, value: str, label: str = "Total",
                  out_col: str | None = None) -> DataFrame:
    """AGG-09: sum of ``value`` per ``index`` plus a grand-total row labelled
    ``label`` (a ``rollup`` whose null group is the margin)."""
    out_col = out_col or value
    return (df.rollup(index)
              .agg(F.sum(value).alias(out_col), F.grouping(index).alias("_g"))
              .withColumn(index, F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(index).cast("string")))
              .drop("_g"))


def sum_array(arr, field: str) -> Column:
    """AGG-15: sum of ``field`` over an array of structs (nulls count 0)."""
    return F.aggregate(as_col(arr), F.lit(0.0),
                       lambda acc, x: acc + F.coalesce(x[field].cast("double"), F.lit(0.0)))


def any_element(arr, pred) -> Column:
    """AGG-16: true when any element satisfies ``pred`` (false for empty/null)."""
    return F.coalesce(F.exists(as_col(arr), pred), F.lit(False))
