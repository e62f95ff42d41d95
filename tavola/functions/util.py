"""Small helpers shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def case_map(c, mapping: dict, default=None) -> Column:
    """``CASE c WHEN k1 THEN v1 ... ELSE default END`` from a dict.

    Works in ANSI mode (no map lookup that could fail) and stays inside
    codegen.
    """
    c = as_col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out
