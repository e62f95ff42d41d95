"""Table maintenance as DataFrame -> DataFrame (MRG-01 .. MRG-11).

Each operator returns the *new state* of a target table from its current
state and a batch; ``write_version`` lands that state in a new version
directory and then moves the ``CURRENT`` pointer, so readers never see a
half-written table and a failed job leaves the old version in place (the
all-or-nothing effect of the original's transactions).

Every operator is one or two equi-joins on the key (shuffle on the key, or
a broadcast of the batch keys when Spark sizes them small) plus a union - no
row-by-row work and nothing collected.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.operators.quality import DataQualityError, require_non_empty, require_unique
from tavola.operators.windows import dedup


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source projected onto the target's columns and types (missing -> null)."""
    cols = []
    for f in target.schema.fields:
        if f.name in source.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return source.select(*cols)


def prepare_batch(source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                  order: Sequence | None = None) -> DataFrame:
    """MRG-02: a batch repeating a key either fails (a single statement may not
    update a row twice) or keeps the last row by ``order``."""
    if on_duplicate == "error":
        return require_unique(source, keys)
    if on_duplicate == "last":
        if not order:
            raise ValueError("on_duplicate='last' needs an order")
        return dedup(source, keys, order, keep="last")
    raise ValueError("on_duplicate must be 'error' or 'last'")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, stamp_col: str | None = None,
           stamp: Column | None = None, on_duplicate: str = "error",
           order: Sequence | None = None) -> DataFrame:
    """MRG-01 (+ MRG-02, MRG-10): insert new keys, update existing ones.

    A batch that repeats a key fails, or keeps its last row by ``order`` with
    ``on_duplicate='last'``.

    ``update_cols=None`` replaces whole rows: target rows without a source
    key plus the source. With ``update_cols`` only those columns change on a
    match (other target columns are kept); new keys insert the batch row
    (null for columns the batch lacks). ``stamp_col`` is set to ``stamp`` on every
    updated or inserted row.
    """
    keys = list(keys)
    source = prepare_batch(source, keys, on_duplicate, order)
    if update_cols is None:
        src = _align(source, target)
        if stamp_col:
            src = src.withColumn(stamp_col, stamp.cast(target.schema[stamp_col].dataType))
        return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(src)
    carried = [c for c in source.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in carried],
                      F.lit(True).alias("_in_s"))
    j = target.withColumn("_in_t", F.lit(True)).join(s, keys, "full_outer")
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    out = []
    for f in target.schema.fields:
        c = f.name
        src = F.col(f"_s_{c}") if c in carried else F.lit(None)
        if c in keys:
            out.append(F.col(c))
        elif stamp_col and c == stamp_col:
            out.append(F.when(in_s, stamp).otherwise(F.col(c)).cast(f.dataType).alias(c))
        elif c in update_cols:
            out.append(F.when(in_s, src).otherwise(F.col(c)).cast(f.dataType).alias(c))
        else:
            out.append(F.when(in_t, F.col(c)).otherwise(src).cast(f.dataType).alias(c))
    return j.select(*out)


def replace_keys(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """MRG-03: delete every target row whose key occurs in the batch, then
    insert the batch (duplicates of the batch are kept)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (target.join(source.select(*keys).distinct(), keys, "left_anti")
                  .unionByName(_align(source, target)))


def drop_superseded_any(target: DataFrame, source: DataFrame, part_keys: Sequence[str],
                        version: str) -> DataFrame:
    """MRG-04: delete target rows that share ``part_keys`` with *some* batch
    row of a different version (``t.version <> s.version``; a null version on
    either side compares unknown, so such rows stay)."""
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in part_keys],
                      F.col(version).alias("_s_version")).distinct()
    cond = None
    for k in part_keys:
        c = F.col(k) == F.col(f"_s_{k}")
        cond = c if cond is None else cond & c
    cond = cond & (F.col(version) != F.col("_s_version"))
    return target.join(s, cond, "left_anti")


def drop_superseded_absent(target: DataFrame, source: DataFrame, part_keys: Sequence[str],
                           version: str) -> DataFrame:
    """MRG-05: delete target rows whose ``part_keys`` occur in the batch while
    their version occurs in *no* batch row of those keys (a null version is
    never "present", so it is deleted)."""
    pk = list(part_keys)
    parts = source.select(*pk).distinct()
    versions = source.select(*pk, version).filter(F.col(version).isNotNull()).distinct()
    untouched = target.join(parts, pk, "left_anti")
    still_sent = target.join(versions, [*pk, version], "left_semi")
    return untouched.unionByName(still_sent)


def replace_range(target: DataFrame, source: DataFrame, col: str, start, end,
                  allow_empty: bool = False) -> DataFrame:
    """MRG-06 / MRG-11: replace the half-open range ``[start, end)`` of ``col``
    by the batch. An empty batch is refused unless ``allow_empty`` (so a failed
    download never wipes a range), and so is a batch with a row outside the
    range: it would be inserted next to rows that nobody replaced. Target rows
    whose ``col`` is null are outside the range and stay."""
    in_range = F.coalesce((F.col(col) >= F.lit(start)) & (F.col(col) < F.lit(end)), F.lit(False))
    if not allow_empty:
        require_non_empty(source, "replacement batch")
    if not source.filter(~in_range).isEmpty():
        raise DataQualityError(f"batch has rows outside [{start}, {end}) of {col}")
    return target.filter(~in_range).unionByName(_align(source, target))


def replace_partitions(target: DataFrame, source: DataFrame, part_expr) -> DataFrame:
    """MRG-07: replace every partition (e.g. ``year(date)``) present in the
    batch."""
    t = target.withColumn("_part", part_expr)
    parts = source.select(part_expr.alias("_part")).distinct()
    return (t.join(parts, "_part", "left_anti").drop("_part")
             .unionByName(_align(source, target)))


def sync(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MRG-08: full synchronisation - upsert the batch and delete target rows
    absent from it. Columns the batch lacks keep the matched target value."""
    keys = list(keys)
    extra = [c for c in target.columns if c not in source.columns]
    base = source.select(*[c for c in source.columns if c in target.columns])
    if extra:
        base = base.join(target.select(*keys, *extra), keys, "left")
    return _align(base, target)


def apply_renames(target: DataFrame, mapping: DataFrame, col: str,
                  old: str = "old", new: str = "new") -> DataFrame:
    """MRG-09: propagate renames (old value -> new value) into ``col``. A mapping
    that gives one old value two new ones fails (it would multiply rows)."""
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new")).distinct()
    m = require_unique(m.filter(F.col("_old").isNotNull()), ["_old"])
    return (target.join(m, F.col(col) == F.col("_old"), "left")
                  .withColumn(col, F.coalesce(F.col("_new"), F.col(col)))
                  .drop("_old", "_new"))


# -- versioned storage (MRG-11) ------------------------------------------------
def _file_system(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current_paths(spark, base: str) -> list[str]:
    """Directories of the current version of a table (one, or one per
    partition), none if the table has no pointer file yet; any other failure to
    read it is raised."""
    fs, pointer = _file_system(spark, f"{base}/CURRENT")
    if not fs.exists(pointer):
        return []
    paths = [r[0] for r in spark.read.text(f"{base}/CURRENT").collect()]  # one line per directory
    if not paths:
        raise ValueError(f"empty pointer {base}/CURRENT")
    return paths


def read_table(spark, base: str) -> DataFrame | None:
    paths = current_paths(spark, base)
    return spark.read.parquet(*paths) if paths else None


def _next_version(base: str, paths: Sequence[str]) -> str:
    """A directory name that no attempt used before, numbered after the current version."""
    last = max((int(re.search(r"/v(\d+)-", p)[1]) for p in paths), default=0)
    return f"{base}/v{last + 1:06d}-{uuid.uuid4().hex[:8]}"


def _point_at(spark, base: str, paths: Sequence[str]) -> None:
    """Replace the pointer file in one rename, so a reader sees the old or the
    new version and never none."""
    jvm = spark.sparkContext._jvm
    fs, draft = _file_system(spark, f"{base}/.current-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray("\n".join(paths).encode()))
    finally:
        out.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(options, 1)
    overwrite[0] = options.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(draft),
                   context.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{base}/CURRENT")), overwrite)


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version and then point ``CURRENT`` at it.

    The new state is fully written before the pointer moves, so a job that
    dies before that leaves the previous version current. Every attempt has a
    directory name of its own: what a dead attempt left behind is in nobody's
    way, and a rerun starts afresh.
    """
    spark = df.sparkSession
    path = _next_version(base, current_paths(spark, base))
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    _point_at(spark, base, [path])
    return path


def _part_of(path: str) -> str | None:
    """The partition value in a directory name; False-like only for none."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if not name.startswith("_part="):
        raise ValueError(f"{path} is no partition directory")
    value = unquote(name[len("_part="):])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def rewrite_partitions(spark, base: str, batch: DataFrame, part: str, change) -> list[str]:
    """MRG-11 by partition: only the partitions of column ``part`` that the
    batch holds are read, changed and written; the pointer then lists their new
    directories beside the untouched old ones.

    ``change(target or None, batch)`` gives the new rows of those partitions and
    must keep rows in their partition. The driver handles one line per
    partition, no rows.
    """
    value = F.col(part).cast("string")
    touched = {r[0] for r in batch.select(value).distinct().collect()}
    paths = current_paths(spark, base)
    hit = [p for p in paths if _part_of(p) in touched]
    target = spark.read.parquet(*hit) if hit else None
    path = _next_version(base, paths)
    change(target, batch).withColumn("_part", value).write.mode("errorifexists").partitionBy("_part").parquet(path)
    fs, root = _file_system(spark, path)
    new = [str(s.getPath().toString()) for s in fs.listStatus(root) if s.isDirectory()]
    now = [p for p in paths if p not in hit] + sorted(new)
    if not now:
        raise DataQualityError("the change leaves no rows")
    _point_at(spark, base, now)
    return now


def safe_upsert(df_target_base: str, source: DataFrame, keys: Sequence[str], **kw) -> str:
    """Upsert a batch into a versioned table; refuses an empty batch."""
    spark = source.sparkSession
    if source.isEmpty():
        raise DataQualityError("empty batch")
    target = read_table(spark, df_target_base)
    if target is None:
        new = prepare_batch(source, keys, kw.get("on_duplicate", "error"), kw.get("order"))
    else:
        new = upsert(target, source, keys, **kw)
    return write_version(new, df_target_base)
