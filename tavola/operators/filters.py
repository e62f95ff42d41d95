"""Row filters with pandas-compatible null handling (FLT-01 .. FLT-15).

pandas keeps a null row under a negated test (``~isin``, ``~str.contains(...,
na=False)``) while SQL's ``NOT IN`` / ``NOT rlike`` drop it; the helpers say
which one they do.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.strings import any_pattern
from tavola.functions.util import as_col

# Noise patterns of menu item names (modifier lines, tax, seat
# numbers, allergy notes, refunds and similar), matched anywhere.
NOISE_PATTERNS = [
    r"^No ",
    r" Only$",
    r" Tax$",
    r"^& ",
    r"^Seat ",
    r"Allergy$",
    r"Outstanding$",
    r"for Salad.*",
    r".*for Steak.*",
    r".*for Sand.*",
    r".*for Taco.*",
    r".*for Cali-Club.*",
    r".*for Edge.*",
    r".*See Server.*",
    r".*Refund.*",
    r".*2 Pens.*",
]


def not_in(df: DataFrame, col: str, values: Iterable, keep_null: bool = True) -> DataFrame:
    """FLT-03: rows whose ``col`` is not in ``values``; nulls kept (pandas)
    unless ``keep_null=False`` (SQL)."""
    hit = as_col(col).isin(list(values))
    return df.filter(~F.coalesce(hit, F.lit(False)) if keep_null else ~hit)


def all_null(cols: Sequence[str]) -> Column:
    """FLT-06: every one of ``cols`` is null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return cond


def affix_filter(df: DataFrame, col: str, prefixes: Sequence[str] = (),
                 suffixes: Sequence[str] = (), negate: bool = False) -> DataFrame:
    """FLT-07: keep names starting with any prefix or ending with any suffix
    (``negate`` keeps the others, nulls included)."""
    c = as_col(col)
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | c.startswith(p)
    for s in suffixes:
        hit = hit | c.endswith(s)
    hit = F.coalesce(hit, F.lit(False))
    return df.filter(~hit if negate else hit)


def noise_filter(df: DataFrame, col: str, patterns: Sequence[str] = tuple(NOISE_PATTERNS)) -> DataFrame:
    """FLT-09: drop names matching any noise pattern; null names are kept."""
    return df.filter(~F.coalesce(any_pattern(col, patterns), F.lit(False)))


def drop_returns(df: DataFrame, col: str) -> DataFrame:
    """FLT-10: drop values written as ``(x)`` (returns); nulls kept."""
    return df.filter(~F.coalesce(as_col(col).rlike(r"^\((.+)\)"), F.lit(False)))


def remove_special(df: DataFrame, col: str, exclusions: DataFrame | None,
                   patterns: Sequence[str] = tuple(NOISE_PATTERNS)) -> DataFrame:
    """FLT-14: remove exact matches of an exclusion list (left-anti join on
    the distinct list) and names matching the noise patterns."""
    if exclusions is not None:
        ex = exclusions.select(F.col(exclusions.columns[0]).alias("_ex")).distinct()
        df = df.join(ex, as_col(col) == F.col("_ex"), "left_anti")
    return noise_filter(df, col, patterns)


def range_filter(df: DataFrame, col: str, start=None, end=None, end_inclusive: bool = False) -> DataFrame:
    """FLT-12: half-open ``[start, end)`` by default (one rule for every feed)."""
    c = as_col(col)
    if start is not None:
        df = df.filter(c >= F.lit(start))
    if end is not None:
        df = df.filter(c <= F.lit(end) if end_inclusive else c < F.lit(end))
    return df
