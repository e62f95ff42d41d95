"""Per-group picks and group-relative measures (WIN-01..04, AGG-13).

Skew: ``top_per_group`` uses ``row_number() = 1``, which Spark plans with a
partial ``WindowGroupLimit`` *before* the shuffle, so even a key holding a
third of the rows sends at most one row per input partition across the
network. ``vs_group_mean`` aggregates (with map-side partial aggregation)
and joins the one-row-per-group result back instead of a window over the
whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.functions.util import as_col


def _order_cols(order: Sequence, descending: bool) -> list[Column]:
    cols = []
    for o in order:
        c = as_col(o)
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return cols


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence,
                  descending: bool = True, n: int = 1,
                  rank_col: str | None = None) -> DataFrame:
    """WIN-01 (newest, ``descending=True``) / WIN-02 (oldest) row per group.

    ``order`` must end in unique tie-breakers for a deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order, descending))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence, keep: str = "last") -> DataFrame:
    """AGG-13: one row per key; ``keep='last'`` keeps the greatest ``order``
    (latest arrival), ``'first'`` the smallest."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    return top_per_group(df, keys, order, descending=(keep == "last"))


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence,
                   cols: Sequence[str], suffix: str = "_first") -> DataFrame:
    """WIN-03: attach the values of the first row (by ``order``) of each group
    to every row of the group."""
    used = [*keys, *[o for o in order if isinstance(o, str)], *cols]
    narrow = df.select(*dict.fromkeys(used)) if all(isinstance(o, str) for o in order) else df
    first = top_per_group(narrow, keys, order, descending=False)
    first = first.select(*keys, *[F.col(c).alias(c + suffix) for c in cols])
    return df.join(first, list(keys), "left")


def vs_group_mean(df: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """WIN-04 / AGG-06: for each ``flag -> measure`` add ``flag`` = "not below
    the group mean" with pandas semantics (mean skips nulls; a null value or
    a null mean compares as not below)."""
    means = df.groupBy(*keys).agg(*[F.avg(m).alias(f"_mean_{m}") for m in set(measures.values())])
    out = df.join(means, list(keys), "left")
    for flag, m in measures.items():
        out = out.withColumn(flag, ~F.coalesce(F.col(m) < F.col(f"_mean_{m}"), F.lit(False)))
    return out.drop(*[f"_mean_{m}" for m in set(measures.values())])
