"""Helpers shared by the operators: table access, lineage cuts, Arrow mapping."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tavola.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A given table, with only the columns that are asked for."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def park(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Write ``df`` as a table below the shared checkpoint folder and read it back.

    The result has no lineage: a lost executor costs the tasks that were
    running, not the stages before them. ``tidy`` lets the JVM drop shuffle
    files of the finished stages at once instead of at its next collection.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/parked-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    if tidy:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


#: Rows of a few numbers that one task is worth starting for.
TASK_ROWS = 250_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than its ``rows`` numbers are worth, one for each core at least.

    A step on a small table otherwise starts as many tasks, and leaves as many
    files, as the session has shuffle partitions. Above that size nothing changes.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


#: Most bytes of a batch that is handed to a Python worker.
BATCH_BYTES = 16 << 20


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict | None],
              schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one record batch to dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    # a session setting: long texts must not make batches of many times the usual size
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for cols in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, type=f.type)
                     for c, f in ((cols[f.name], f) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def discard(parked: DataFrame) -> None:
    """Delete a table that ``park`` wrote and that nothing reads any more."""
    spark = parked.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    for file in parked.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if path.getName().startswith("parked-") and root.split(":", 1)[-1].lstrip("/") in path.toString():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
