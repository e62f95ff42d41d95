"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library expects; a cluster may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tavola",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only applied when given, so on a cluster the submitter's
    master wins.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    folder). Only on a local master (unit tests, a laptop) an unset directory
    becomes a local temporary one; a cluster without the setting is refused,
    because its executors would write where the others cannot read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tavola-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def written(df: DataFrame, tidy: bool = False) -> DataFrame:
    """``df`` as a table below the shared checkpoint folder: a step that several
    readers need is computed and shuffled once, and they read only their columns.
    ``tidy`` lets the JVM drop the step's shuffle files at once instead of at its
    next collection."""
    path = scratch_path(df.sparkSession, f"step-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    if tidy:
        df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tavola", name)
