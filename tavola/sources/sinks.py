"""Writers (SNK-01 .. SNK-06)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.operators.aggregates import with_totals
from tavola.operators.ordering import sort_keys


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-01: append to a table directory."""
    df.write.mode("append").format(fmt).save(path)


def overwrite(df: DataFrame, path: str, schema_of: DataFrame | None = None,
              partition_by: Sequence[str] = ()) -> None:
    """SNK-02: truncate and reload; the schema must match the table's when a
    current state is given. With ``partition_by`` only the partitions present
    in ``df`` are replaced (dynamic partition overwrite)."""
    if schema_of is not None and [f.name for f in schema_of.schema] != [f.name for f in df.schema]:
        raise ValueError("schema differs from the table's")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """SNK-03: CSV with a header (``single_file`` only for small reports)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str, partition_by: Sequence[str] = ("location", "category2"),
                 order_by: Sequence = (), sections: Sequence[str] = (), totals: Sequence[str] = (),
                 ratios: dict[str, tuple[str, str, float]] | None = None) -> None:
    """SNK-04: one output folder per store and category (the workbook's sheets),
    sorted by ``order_by`` (names or (name, "desc")) end to end: read in the order of
    their names, the files of a folder are the sorted rows.

    With ``sections`` a folder holds its sections one after the other, each closed
    by a totals row (``row_type`` "Total") of the measures ``totals`` and the
    ``ratios`` of ``with_totals``. Rows are dealt by ranges of the whole sort order,
    ties by all columns, so a large folder gets several tasks and files, and a
    task that runs again gets the same rows.
    """
    folders = [*partition_by, *sections]
    keys = [*folders]
    if totals:
        df = with_totals(df, folders, totals, ratios)
        keys.append((F.col("row_type") == "Total"))
    ties = [c for c in df.columns if c not in folders]
    out = df.orderBy(*sort_keys([*keys, *order_by, F.xxhash64(*ties)]))
    out.write.mode("overwrite").option("header", True).partitionBy(*partition_by).csv(path)


def write_bundle(frames: dict[str, DataFrame], path: str, fmt: str = "csv") -> None:
    """SNK-05: several named result tables under one folder."""
    for name, df in frames.items():
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(f"{path}/{name}")
        else:
            w.format(fmt).save(f"{path}/{name}")


def write_jdbc(df: DataFrame, url: str, table: str, props: dict, batch_size: int = 1000) -> None:
    """SNK-06: batched insert into a database table (``batchsize`` rows per
    statement, one connection per task)."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=props)
