"""Data-quality checks (DQ-01 .. DQ-08).

Checks that must stop a job run one aggregate action (a count) - never a
collect of the data. Reports are DataFrames to be written to a quarantine
table next to the result.

``checked`` and ``write_checked`` do all checks on the way to a table: rows are
marked with what is wrong with them, counted while they are written
(``Observation``) and dealt to the table or to a quarantine folder by the same
job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    pass


def require_not_null(df: DataFrame, col: str) -> DataFrame:
    """DQ-01: fail when ``col`` has a null."""
    n = df.filter(F.col(col).isNull()).limit(1).count()
    if n:
        raise DataQualityError(f"null value in {col}")
    return df


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-02: fail when a key occurs twice."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise DataQualityError(f"duplicate key {list(keys)}")
    return df


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-03: every row whose key occurs more than once, with the count.

    Counts come from a ``groupBy`` joined back on the key (no window holding
    a whole hot group in one task).
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    return df.join(counts, list(keys), "inner")


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DQ-04: rows with a null in any of ``cols`` (all columns by default)."""
    cols = list(cols or df.columns)
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def unmapped_report(df: DataFrame, col: str, mapping: DataFrame, map_col: str) -> DataFrame:
    """DQ-05: distinct values of ``col`` that the mapping does not cover
    (run before a default is filled in)."""
    keys = mapping.select(F.col(map_col).alias(col))
    return df.select(col).filter(F.col(col).isNotNull()).distinct().join(keys, col, "left_anti")


def require_non_empty(df: DataFrame, what: str = "batch") -> DataFrame:
    """DQ-08: refuse an empty input (so a replace never wipes a range)."""
    if df.isEmpty():
        raise DataQualityError(f"empty {what}")
    return df


def quarantine_split(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Split into (good, bad) rows by a predicate (null counts as good)."""
    flag = F.coalesce(bad, F.lit(False))
    return df.filter(~flag), df.filter(flag)


def checked(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
            mapped: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """``df`` with ``problems``, the list of what is wrong with each row (empty for a good one).

    * ``null <column>`` for a null in a column of ``not_null`` (DQ-01, DQ-04);
    * ``duplicate key`` where the columns ``unique`` together repeat; a key with
      a null in it repeats nothing (DQ-02, DQ-03);
    * ``unmapped <column>`` for a value that ``mapped[column]``, a table and its
      key column, does not hold (DQ-05); a null is not unmapped.

    Row order and columns stay; a repeated key is counted by a grouping that is
    joined back, so a hot key does not gather in one task.
    """
    out, found = df, [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in not_null]
    if unique:
        keys = list(unique)
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        copies = df.filter(present).groupBy(*keys).agg(F.count("*").alias("_copies")).filter("_copies > 1")
        out = out.join(copies, keys, "left")
        found.append(F.when(F.col("_copies").isNotNull(), F.lit("duplicate key")))
    for n, (c, (table, key)) in enumerate((mapped or {}).items()):
        known = table.select(F.col(key).alias(f"_key{n}")).filter(F.col(f"_key{n}").isNotNull()).distinct()
        out = out.join(known, F.col(c) == F.col(f"_key{n}"), "left")
        found.append(F.when(F.col(c).isNotNull() & F.col(f"_key{n}").isNull(), F.lit(f"unmapped {c}")))
    return out.select(*df.columns, F.array_compact(F.array(*found)).alias("problems") if found
                      else F.array().cast("array<string>").alias("problems"))


def write_checked(df: DataFrame, path: str, not_null: Sequence[str] = (), unique: Sequence[str] = (),
                  mapped: Mapping[str, tuple[DataFrame, str]] | None = None, fail_on: Sequence[str] = (),
                  allow_empty: bool = False) -> dict[str, int]:
    """Write the good rows to ``path/good`` and the others, with ``problems``, to ``path/bad``, in one job.

    Returns ``rows`` and how many rows have each problem, counted on the way. Raises
    after writing if a problem of ``fail_on`` (by its full text) occurred or, unless
    ``allow_empty``, nothing came in (DQ-08): the folders then hold what was
    found, and nothing is moved on. Both folders are read back as columns of
    ``df`` by ``read_checked``.
    """
    names = [f"null {c}" for c in not_null] + ["duplicate key"] * bool(unique) + [f"unmapped {c}" for c in mapped or {}]
    seen = Observation()
    rows = checked(df, not_null, unique, mapped)
    counts = [F.count_if(F.array_contains("problems", n)).alias(n) for n in names]
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
     .withColumn("_kind", F.when(F.size("problems") > 0, "bad").otherwise("good"))
     .write.mode("overwrite").partitionBy("_kind").parquet(path))
    got = {k: int(v or 0) for k, v in seen.get.items()}
    if not got["rows"] and not allow_empty:
        raise DataQualityError("empty batch")
    failed = [n for n in fail_on if got.get(n)]
    if failed:
        raise DataQualityError(", ".join(f"{got[n]} rows: {n}" for n in failed))
    return got


def read_checked(spark, path: str, schema, good: bool = True) -> DataFrame:
    """The good rows that ``write_checked`` wrote, or the bad ones with their problems."""
    from pyspark.sql.types import ArrayType, StringType, StructType
    full = StructType([*schema.fields]).add("problems", ArrayType(StringType())).add("_kind", StringType())
    rows = spark.read.schema(full).parquet(path).filter(F.col("_kind") == ("good" if good else "bad")).drop("_kind")
    return rows.drop("problems") if good else rows
