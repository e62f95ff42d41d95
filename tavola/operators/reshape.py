"""Reshaping (RSH-01 .. RSH-04) and column projection helpers (PRJ-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None,
            var_name: str = "period", value_name: str = "amount") -> DataFrame:
    """RSH-01/02: wide -> long; ``values=None`` unpivots every non-id column.
    Value columns are cast to double first so mixed numeric types line up."""
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    df = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return df.unpivot(list(ids), values, var_name, value_name)


def densify(items: DataFrame, start, end, date_col: str = "date") -> DataFrame:
    """RSH-04 / DT-06: every item row once per day of ``[start, end]``,
    generated per row (``explode(sequence)``) instead of a cross join."""
    return items.withColumn(date_col, F.explode(F.sequence(F.to_date(F.lit(start)),
                                                           F.to_date(F.lit(end)))))


def project(df: DataFrame, cols: Sequence[str], fill_missing: bool = True) -> DataFrame:
    """PRJ-01: columns in the given order; absent ones become null (``reindex``)."""
    out = []
    for c in cols:
        if c in df.columns:
            out.append(F.col(c))
        elif fill_missing:
            out.append(F.lit(None).alias(c))
        else:
            raise KeyError(c)
    return df.select(*out)


def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """PRJ-02 (strict form): fail when a column to drop does not exist."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(missing)
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str], case_insensitive: bool = True) -> DataFrame:
    """PRJ-03: rename by map; with ``case_insensitive`` a key matches a column
    whatever its case (feeds spell ``jobTitle_Id`` and ``jobTitle_ID``)."""
    if case_insensitive:
        low = {k.lower(): v for k, v in mapping.items()}
        return df.withColumnsRenamed({c: low[c.lower()] for c in df.columns if c.lower() in low})
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def lower_names(df: DataFrame) -> DataFrame:
    """PRJ-03: camelCase -> lower case column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def cast_to(df: DataFrame, types: dict[str, str], safe: bool = True) -> DataFrame:
    """PRJ-05: cast columns; ``safe`` turns bad values into null (``try_cast``)."""
    return df.withColumns({c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t))
                           for c, t in types.items() if c in df.columns})


def fill(df: DataFrame, mapping: dict) -> DataFrame:
    """PRJ-06: typed null fill per column (never 0 into a text column)."""
    return df.fillna(mapping)


def replace_values(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """PRJ-07: exact value replacement through a map."""
    return df.replace(mapping, subset=[col])


def update_where(df: DataFrame, pred, updates: dict) -> DataFrame:
    """PRJ-11: set several columns where ``pred`` holds (null pred = no)."""
    p = F.coalesce(pred, F.lit(False))
    return df.withColumns({c: F.when(p, v).otherwise(F.col(c)) for c, v in updates.items()})
