"""Numeric and conditional expressions (NUM-01 .. NUM-09, N3/N4 rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions.util import as_col


def nan_to_null(c) -> Column:
    """N3: a NaN double becomes null so sums and means skip it."""
    c = as_col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_ratio(a, b, default=0.0) -> Column:
    """NUM-01/02: ``a / b`` when ``b`` is non-zero, else ``default``.

    A null ``b`` counts as zero, as a falsy value does in Python.
    """
    a, b = as_col(a), as_col(b)
    return F.when(F.coalesce(b, F.lit(0)) != 0, F.try_divide(a, b)) \
        .otherwise(F.lit(default).cast("double"))


def unit_cost(amount, qty, base_qty) -> Column:
    """NUM-03: ``amount / qty / base_qty`` when both are positive, else 0."""
    amount, qty, base_qty = as_col(amount), as_col(qty), as_col(base_qty)
    ok = F.coalesce((qty > 0) & (base_qty > 0), F.lit(False))
    return F.when(ok, amount / qty / base_qty).otherwise(F.lit(0.0))


def nullif_div(a, b) -> Column:
    """NUM-04: ``a / NULLIF(b, 0)``."""
    return F.try_divide(as_col(a), F.nullif(as_col(b), F.lit(0)))


def not_below(x, ref) -> Column:
    """N4: pandas' ``not (x < ref)`` where a null comparison is False."""
    return ~F.coalesce(as_col(x) < as_col(ref), F.lit(False))


def rating(qty_high, margin_high) -> Column:
    """NUM-08: menu-engineering class from two flags."""
    q, m = as_col(qty_high), as_col(margin_high)
    # The four class names.
    return (F.when(q & m, F.lit("Star"))
             .when(q & ~m, F.lit("Opportunity"))
             .when(~q & m, F.lit("Puzzle"))
             .otherwise(F.lit("Dog")))


# The six directed unit pairs and which item quantities form
# the factor (numerator, denominator).
UNIT_PAIRS = {
    ("OZ-fl", "OZ-wt"): ("volume_qty", "weight_qty"),
    ("OZ-wt", "OZ-fl"): ("weight_qty", "volume_qty"),
    ("Each", "OZ-wt"): ("each_qty", "weight_qty"),
    ("Each", "OZ-fl"): ("each_qty", "volume_qty"),
    ("OZ-wt", "Each"): ("weight_qty", "each_qty"),
    ("OZ-fl", "Each"): ("volume_qty", "each_qty"),
}


def conversion_factor(uofm, base_uofm, weight_qty="weight_qty",
                      volume_qty="volume_qty", each_qty="each_qty") -> Column:
    """NUM-07: factor turning a quantity in ``uofm`` into ``base_uofm`` from
    the item's weight / volume / each equivalents.

    Same unit -> 1; one of the six pairs -> ratio of the item quantities
    (null when the denominator is 0); any other pair -> 1 (reported by
    ``is_known_pair``).
    """
    u, b = as_col(uofm), as_col(base_uofm)
    q = {"weight_qty": as_col(weight_qty), "volume_qty": as_col(volume_qty),
         "each_qty": as_col(each_qty)}
    out = F.when(u == b, F.lit(1.0))
    for (src, dst), (num, den) in UNIT_PAIRS.items():
        out = out.when((u == F.lit(src)) & (b == F.lit(dst)), nullif_div(q[num], q[den]))
    return out.otherwise(F.lit(1.0))


def is_known_pair(uofm, base_uofm) -> Column:
    u, b = as_col(uofm), as_col(base_uofm)
    cond = u == b
    for (src, dst) in UNIT_PAIRS:
        cond = cond | ((u == F.lit(src)) & (b == F.lit(dst)))
    return F.coalesce(cond, F.lit(False))
