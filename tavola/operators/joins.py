"""Join patterns beyond a plain equi-join (JN-13 .. JN-19).

No operator here builds a cross product or a range join: as-of lookups for
many dates are turned into "validity intervals" that are expanded with
``explode(sequence())`` per key, and fallbacks are one full-outer equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.functions.util import as_col
from tavola.operators.windows import top_per_group


def latest_as_of(df: DataFrame, keys: Sequence[str], ts: str, as_of, order: Sequence,
                 descending: bool = True) -> DataFrame:
    """JN-13: per key, the newest (or oldest) row with ``ts <= as_of``."""
    bound = F.lit(as_of) if not isinstance(as_of, Column) else as_of
    return top_per_group(df.filter(F.col(ts) <= bound), keys, order, descending)


def latest_as_of_all(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence,
                     first_bucket: int, last_bucket: int, out_col: str | None = None) -> DataFrame:
    """JN-14: the newest row at or before *every* bucket (week) in
    ``[first_bucket, last_bucket]``, per key.

    1. keep the newest row per (keys, bucket) - partial window limit, so a
       hot key ships one row per input partition;
    2. ``lead`` over the per-key bucket list gives how long each row stays
       the newest (a key has at most one row per bucket, so the window is
       bounded by the number of buckets, not by the data);
    3. expand each row over its buckets inside the requested range.
    """
    out_col = out_col or bucket
    last = top_per_group(df, [*keys, bucket], order, descending=True)
    nxt = F.lead(bucket).over(Window.partitionBy(*keys).orderBy(bucket))
    spans = (last.withColumn("_next", nxt)
                 .withColumn("_lo", F.greatest(F.col(bucket), F.lit(first_bucket)))
                 .withColumn("_hi", F.least(F.coalesce(F.col("_next") - 1, F.lit(last_bucket)),
                                            F.lit(last_bucket)))
                 .filter(F.col("_lo") <= F.col("_hi")))
    res = (spans.withColumn("_b", F.explode(F.sequence("_lo", "_hi")))
                .drop("_next", "_lo", "_hi"))
    if out_col == bucket:
        res = res.drop(bucket)
    return res.withColumnRenamed("_b", out_col)


def valid_from(df: DataFrame, start_col: str, first_bucket: int, last_bucket: int,
               out_col: str) -> DataFrame:
    """Expand a row valid from ``start_col`` onwards over the buckets of
    ``[first_bucket, last_bucket]`` (a fallback that never expires)."""
    lo = F.greatest(F.col(start_col), F.lit(first_bucket))
    return (df.filter(lo <= F.lit(last_bucket))
              .withColumn(out_col, F.explode(F.sequence(lo, F.lit(last_bucket)))))


def merge_with_fallback(primary: DataFrame, fallback: DataFrame, on: Sequence[str],
                        cols: Sequence[str], use_fallback_when: Column | None = None) -> DataFrame:
    """JN-19: one full-outer join of a primary and a fallback source.

    For every key, the fallback's ``cols`` win when the primary row is missing
    or when ``use_fallback_when`` holds (it may refer to ``p_<col>`` and
    ``f_<col>``) and a fallback row exists. Replaces the pandas sequence
    left-merge + mask + anti-join + concat with a single shuffle.
    """
    p = primary.select(*on, *[F.col(c).alias(f"p_{c}") for c in cols], F.lit(True).alias("_p"))
    f = fallback.select(*on, *[F.col(c).alias(f"f_{c}") for c in cols], F.lit(True).alias("_f"))
    j = p.join(f, list(on), "full_outer")
    has_p = F.coalesce(F.col("_p"), F.lit(False))
    has_f = F.coalesce(F.col("_f"), F.lit(False))
    cond = ~has_p
    if use_fallback_when is not None:
        cond = cond | (has_f & F.coalesce(use_fallback_when, F.lit(False)))
    return j.select(*on, *[F.when(cond, F.col(f"f_{c}")).otherwise(F.col(f"p_{c}")).alias(c)
                           for c in cols],
                    F.when(cond, F.lit("fallback")).otherwise(F.lit("primary")).alias("source"))


def validate_fk(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """JN-17: null out ``col`` where its value is not a key of ``parent``."""
    keys = parent.select(F.col(parent_col).alias("_fk")).distinct().withColumn("_ok", F.lit(True))
    return (df.join(keys, F.col(col) == F.col("_fk"), "left")
              .withColumn(col, F.when(F.col("_ok"), F.col(col)))
              .drop("_fk", "_ok"))


def find_renamed(old: DataFrame, new: DataFrame, key: str, col: str) -> DataFrame:
    """JN-18: ids whose ``col`` differs between two snapshots."""
    o = old.select(key, F.col(col).alias("old_" + col))
    n = new.select(key, F.col(col).alias("new_" + col))
    return o.join(n, key).filter(~F.col("old_" + col).eqNullSafe(F.col("new_" + col)))


def single_value(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """JN-15: the one value per key of a correlated ``SELECT DISTINCT ..
    LIMIT 1`` made deterministic (smallest value)."""
    return lookup.groupBy(key).agg(F.min(value).alias(value))


def join_checked(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                 suffix: str = "_r") -> DataFrame:
    """JN-16: ``many_to_one`` join - fails when the right side repeats a key;
    overlapping non-key columns of the right side get ``suffix``."""
    from tavola.operators.quality import require_unique
    require_unique(right, on)
    overlap = [c for c in right.columns if c in left.columns and c not in on]
    r = right.select(*[F.col(c).alias(c + suffix) if c in overlap else F.col(c)
                       for c in right.columns])
    return left.join(r, list(on), how)


def coalesce_cols(a, b) -> Column:
    """PRJ-09: first non-null of two columns (``name_x`` else ``name_y``)."""
    return F.coalesce(as_col(a), as_col(b))
