"""Nested data helpers (NST-01/02, SRC-07/08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.functions.util import as_col


def flatten(df: DataFrame, sep: str = ".", keep_arrays: bool = True) -> DataFrame:
    """NST-02 (``json_normalize``): every struct leaf becomes a top-level
    column named by its path (``server.guid``); arrays are left alone."""
    cols: list[Column] = []

    def walk(prefix: str, dtype: T.DataType, path: Column) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f"{prefix}{sep}{f.name}" if prefix else f.name, f.dataType, path[f.name])
        elif keep_arrays or not isinstance(dtype, T.ArrayType):
            cols.append(path.alias(prefix))

    for f in df.schema.fields:
        walk(f.name, f.dataType, F.col(f"`{f.name}`"))
    return df.select(*cols)


def pick(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """NST-01: output column -> struct path (``'itemCategory1.name'``); a
    missing parent gives null, so no guards are needed."""
    return df.select(*[F.col(path).alias(out) for out, path in fields.items()])


def json_array_elements(c) -> Column:
    """Elements of a JSON array text as raw JSON texts (objects stay text, so
    a tree of any depth can be walked one level at a time)."""
    return F.from_json(as_col(c), T.ArrayType(T.StringType()))


def as_array(c) -> Column:
    """SRC-08: a JSON value that may be one object or a list of objects, as
    a list of object texts."""
    c = as_col(c)
    trimmed = F.ltrim(c)
    return F.when(trimmed.startswith("["), json_array_elements(c)) \
            .when(trimmed.startswith("{"), F.array(c))
