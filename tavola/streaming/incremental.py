"""Incremental table maintenance with Structured Streaming (INC-01/02).

Two ways to keep a table current from landed feed files:

* ``upsert_log``: the stream drops rows that were delivered twice (a stateful
  step, its memory bounded by a watermark) and files every micro-batch in a
  directory named by its number, so a batch that runs again after a failure
  overwrites itself and is never counted twice. ``current_rows`` reads the table
  from that log: of every part (say a store's day) the newest summary, of every
  key the newest row. Nothing is rewritten while the stream runs.
* ``incremental_upsert``: every micro-batch is applied to the target table at
  once, see below.

For the second, landed feed files arrive in a directory; each micro-batch is applied to the
versioned target table with ``foreachBatch``: superseded versions of the
batch's (location, date) partitions are dropped (MRG-05, late corrections),
then the batch is upserted (MRG-01) and the new state written as a new
version (MRG-11). The stream's checkpoint records which files were applied,
so a restarted job (lost executor, lost driver) continues where it stopped
and a batch is never applied twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.operators import merge
from tavola.operators.windows import dedup


def apply_batch(spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str],
                part_keys: Sequence[str] | None, version: str | None, partition: str | None = None) -> None:
    """One idempotent step: supersede, upsert, write a new version.

    With ``partition``, a column of both the keys and the part keys, only the
    partitions that the batch holds are read and written.
    """
    if batch.isEmpty():
        return
    if partition and (partition not in keys or (part_keys and partition not in part_keys)):
        raise ValueError("the partition column must be among the keys and the part keys")
    # The batch is used several times (checks, supersede, upsert): it is read
    # from its files once. Versions are never overwritten, so the new state can
    # be computed from the current one and written straight away.
    def change(target, rows):
        if target is None:
            return merge.prepare_batch(rows, keys)
        if part_keys and version:
            target = merge.drop_superseded_absent(target, rows, part_keys, version)
        return merge.upsert(target, rows, keys)

    batch = batch.persist()
    try:
        if partition:
            merge.rewrite_partitions(spark, table, batch, partition, change)
        else:
            merge.write_version(change(merge.read_table(spark, table), batch), table)
    finally:
        batch.unpersist()


def incremental_upsert(spark: SparkSession, landing: str, schema: T.StructType, table: str,
                       checkpoint: str, keys: Sequence[str],
                       part_keys: Sequence[str] | None = None, version: str | None = None,
                       fmt: str = "parquet", available_now: bool = True, partition: str | None = None):
    """Start the stream; with ``available_now`` it processes every landed
    file and stops (a catch-up run), otherwise it keeps running."""
    from tavola.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    stream = spark.readStream.schema(schema).format(fmt).load(landing)
    w = (stream.writeStream
         .foreachBatch(lambda df, _id: apply_batch(spark, table, df, keys, part_keys, version, partition))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def without_repeats(stream: DataFrame, keys: Sequence[str], sent: str, delay: str) -> DataFrame:
    """Rows whose ``keys`` were not delivered within ``delay`` before.

    The state holds the keys of the last ``delay`` (by the event time ``sent``),
    whatever the length of the feed.
    """
    return stream.withWatermark(sent, delay).dropDuplicatesWithinWatermark(list(keys))


def upsert_log(spark: SparkSession, landing: str, schema: T.StructType, log: str, checkpoint: str, keys: Sequence[str],
               sent: str, delay: str, fmt: str = "parquet", available_now: bool = True,
               after_batch: Callable[[int], None] | None = None):
    """Start the stream that files landed rows below ``log``, one ``batch=<number>`` directory per micro-batch.

    ``after_batch`` is called once a batch is filed and before it is marked as done.
    """
    from tavola.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rows = without_repeats(spark.readStream.schema(schema).format(fmt).load(landing), keys, sent, delay)

    def file_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")
        if after_batch:
            after_batch(number)

    w = rows.writeStream.foreachBatch(file_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def current_rows(log: DataFrame, keys: Sequence[str], parts: Sequence[str], version: str, sent: str) -> DataFrame:
    """The table that a log of deliveries stands for.

    A row counts if its summary ``version`` is the one that its part
    (``parts``) was last sent with (INC-02: rows of older summaries are gone,
    also those that the newer one no longer has), and if no row with its ``keys``
    was sent later. Equal times are decided by the version, then by the part. Both
    rules are groupings by key; a part of very many rows is one pre-aggregated
    maximum and a join that can be split.
    """
    newest = log.groupBy(*parts).agg(F.max_by(version, F.struct(sent, version)).alias("_newest"))
    last = dedup(log, list(keys), [sent, version, *parts], keep="last")
    return last.join(newest, list(parts)).filter(F.col(version).eqNullSafe(F.col("_newest"))).drop("_newest")
