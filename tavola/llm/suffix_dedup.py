"""Byte-level duplicate removal with a logarithmic family of suffix indexes.

A *window* is a string of ``width`` bytes of one text; every byte covered by a
window that also starts anywhere else (same text included) is removed.

* The suffixes kept are those at winnowed anchors: every window holds the
  start of one, at an offset that depends on the window's content alone. A
  suffix array of a batch is the sorted list of its anchors' suffixes, ordered
  by their first four bytes and then by a fingerprint of their first ``gram``
  bytes, equal prefixes folded into one entry with a count.
* ``SuffixFamily.insert`` merge-scans a batch's array against the levels
  already there (a join on the sort key) and reports the prefixes met on both
  sides; a level of the batch's own rank is merged with it, and the merged
  level moves one rank up, until no level has that rank (a binary counter).
  Over b batches every entry is rewritten O(log b) times.
* Windows that share an anchor form a run. Where all copies of a long match
  have the same run, the run goes as a whole. Where runs differ, one copy of
  each is cut into blocks of eight windows, and only blocks that differ are
  compared window by window.

Groupings are pre-aggregated and keep no list of members, so a passage that a
third of all texts hold is some rows per task; the joins back have one row per
key on one side and can be split. A text that is null is empty; doc_id may be
null or repeated (each row is a text of its own).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm import flat
from tavola.llm.common import discard, map_arrow, park, table

WIDTH = 200
GRAM = 120
BATCHES = 3
BLOCK = 8


def _runs(data, offsets, gram, width):
    codes = flat.BYTE_CODE[data]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    found = flat.window_runs(codes, row, gram, width)
    if found is None:
        return None
    roll, grams, anchor, j0, j1 = found
    run = flat.mix(roll.ranges(j0, j1 - 1 + width) ^ (anchor - j0).astype(np.uint64))
    head = np.zeros(len(anchor), dtype=np.uint64)
    for i in range(4):
        head = (head << np.uint64(8)) | data[anchor + i].astype(np.uint64)
    suffix = ((head << np.uint64(32)) | (grams[anchor] >> np.uint64(32))) ^ np.uint64(1 << 63)
    return roll, row, suffix.view(np.int64), run, anchor, j0, j1


def _scan(gram: int, width: int):
    def fn(batch: pa.RecordBatch):
        ids = batch.column("doc_id")
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            found = _runs(data, offsets, gram, width)
            if found is not None:
                _, row, suffix, run, _, j0, _ = found
                yield {"doc_id": ids.slice(a, b - a).take(pa.array(row[j0])), "suffix": suffix,
                       "run": run.view(np.int64)}
    return fn


def _keyed(run: np.ndarray, row: np.ndarray) -> np.ndarray:
    return flat.mix(run + flat.mix(row.astype(np.uint64) + np.uint64(1)))


def _expand(j0, j1):
    n = j1 - j0
    return np.repeat(j0, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), n


def _blocks(gram: int, width: int):
    """Blocks of windows of the runs that a document is asked for."""
    def fn(batch: pa.RecordBatch):
        want = batch.column("want")
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            found = _runs(data, offsets, gram, width)
            if found is None:
                continue
            roll, row, _, run, anchor, j0, j1 = found
            part = want.slice(a, b - a)
            asked = part.flatten().to_numpy().view(np.uint64)
            asker = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            keep = np.isin(_keyed(run, row[j0]), _keyed(asked, asker))
            run, once = np.unique(run[keep], return_index=True)
            anchor, j0, j1 = anchor[keep][once], j0[keep][once], j1[keep][once]
            if not len(run):
                continue
            j, n = _expand(j0, j1)
            of = np.repeat(np.arange(len(run)), n)
            blk = (anchor[of] - j) // BLOCK
            first = np.r_[True, (of[1:] != of[:-1]) | (blk[1:] != blk[:-1])]
            at = np.flatnonzero(first)
            end = np.r_[at[1:], len(j)]
            of, blk, ja, jb = of[at], blk[at], j[at], j[end - 1]
            lead = anchor[of] - blk * BLOCK
            tag = flat.mix(blk.astype(np.uint64) + np.uint64(17))
            core = flat.mix(roll.ranges(lead, lead - (BLOCK - 1) + width) ^ tag)
            whole = flat.mix(roll.ranges(ja, jb + width) ^ tag ^ (lead - ja).astype(np.uint64))
            wins = roll.ranges(j, j + width).view(np.int64)
            yield {"run": run[of].view(np.int64), "blk": blk.astype(np.int32), "low": (lead - jb).astype(np.int32),
                   "core": core.view(np.int64), "whole": whole.view(np.int64),
                   "wins": pa.ListArray.from_arrays(pa.array(np.r_[at, len(j)], pa.int32()), pa.array(wins))}
    return fn


def _cut(gram: int, width: int):
    """Remove the marked windows' bytes of every text."""
    def fn(batch: pa.RecordBatch):
        marks = batch.column("marks")
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            gone = np.zeros(len(data) + 1, dtype=np.int32)
            part = marks.slice(a, b - a)
            given = part.flatten()
            found = _runs(data, offsets, gram, width) if len(given) else None
            if found is not None:
                _, row, _, run, anchor, j0, j1 = found
                asker = np.repeat(np.arange(b - a), np.diff(part.fill_null([]).offsets.to_numpy()))
                key = _keyed(given.field("run").to_numpy().view(np.uint64), asker)
                blk = given.field("blk").to_numpy()
                own = _keyed(run, row[j0])
                whole = np.isin(own, key[blk < 0])
                np.add.at(gone, j0[whole], 1)
                np.add.at(gone, j1[whole] - 1 + width, -1)
                some = ~whole & np.isin(own, key[blk >= 0])
                if some.any():
                    j, n = _expand(j0[some], j1[some])
                    back = np.repeat(anchor[some], n) - j
                    mine = flat.mix(np.repeat(own[some], n) + (back // BLOCK).astype(np.uint64))
                    keys = flat.mix(key[blk >= 0] + blk[blk >= 0].astype(np.uint64))
                    order = np.argsort(keys)
                    at = np.minimum(np.searchsorted(keys[order], mine), len(keys) - 1)
                    mask = np.where(keys[order][at] == mine, given.field("mask").to_numpy()[blk >= 0][order][at], 0)
                    j = j[(mask >> (back % BLOCK)) & 1 == 1]
                    np.add.at(gone, j, 1)
                    np.add.at(gone, j + width, -1)
            removed = np.cumsum(gone[:-1]) > 0
            total = np.r_[0, np.cumsum(removed)]
            begins = removed.copy()
            begins[1:] &= ~removed[:-1]
            heads = offsets[:-1][np.diff(offsets) > 0]
            begins[heads] = removed[heads]
            spans = np.r_[0, np.cumsum(begins)]
            kept = data[~removed]
            left = offsets - total[offsets]
            yield {"doc_id": batch.column("doc_id").slice(a, b - a), "n_bytes": np.diff(offsets),
                   "n_removed": np.diff(total[offsets]), "n_spans": np.diff(spans[offsets]),
                   "kept": pa.LargeBinaryArray.from_buffers(
                       pa.large_binary(), b - a,
                       [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.binary())}
    return fn


class SuffixFamily:
    """Levels of suffix entries (suffix, n); rank r holds about 2**r batches."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self._met: list[DataFrame] = []

    @staticmethod
    def array(entries: DataFrame) -> DataFrame:
        """The suffix array of some entries: sorted shards, equal prefixes folded."""
        return park(entries.groupBy("suffix").agg(F.sum("n").alias("n")).sortWithinPartitions("suffix"))

    def insert(self, batch: DataFrame) -> None:
        """Scan a batch's array (suffix, n) against the levels, then carry it up the ranks."""
        for rank, level in self.levels.items():
            if rank:  # the merge below finds what a level of rank 0 shares with the batch
                self._met.append(park(level.join(batch, "suffix", "left_semi").select("suffix")))
        carry, rank = batch, 0
        while rank in self.levels:
            other = self.levels.pop(rank)
            merged = self.array(other.unionByName(carry))
            discard(other)
            discard(carry)
            carry, rank = merged, rank + 1
        self.levels[rank] = carry

    def matches(self) -> DataFrame:
        """Prefixes that occur at two places or more among all batches."""
        out = [level.filter("n > 1").select("suffix") for level in self.levels.values()] + self._met
        df = out[0]
        for x in out[1:]:
            df = df.unionByName(x)
        return df.distinct()


def suffix_dedup(docs: DataFrame, gram: int = GRAM, width: int = WIDTH, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) per input row.

    ``batches`` deliveries of documents (dealt by a hash of doc_id) are inserted
    one after another; the result does not depend on their number.
    """
    if not 8 <= gram <= width - BLOCK:
        raise ValueError("gram must lie between 8 and width - 8")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    runs = park(map_arrow(docs, _scan(gram, width), "doc_id long, suffix long, run long")
                .withColumn("batch", F.expr(f"pmod(hash(doc_id), {batches})")))
    family = SuffixFamily()
    for b in range(batches):
        family.insert(family.array(runs.filter(F.col("batch") == b).select("suffix", F.lit(1).cast("long").alias("n"))))
    recurring = park(family.matches(), tidy=True)
    for level in family.levels.values():
        discard(level)
    held = park(runs.select("doc_id", "suffix", "run").join(recurring, "suffix"), tidy=True)
    discard(runs)
    distinct = park(held.groupBy("suffix", "run").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")))
    mixed = park(distinct.groupBy("suffix").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("suffix"))
    ask = (distinct.join(mixed, "suffix").groupBy("first").agg(F.collect_list("run").alias("want")))
    blocks = park(map_arrow(docs.join(ask.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(ask["first"])),
                            _blocks(gram, width),
                            "run long, blk int, low int, core long, whole long, wins array<long>"), tidy=True)
    cores = park(blocks.groupBy("core").agg(
        F.min("run").alias("r0"), F.max("run").alias("r1"), F.min("whole").alias("w0"), F.max("whole").alias("w1"))
        .filter("r0 <> r1").select("core", F.expr("w0 = w1").alias("same")))
    met = park(blocks.join(cores, "core"), tidy=True)
    wins = park(met.filter("NOT same").select("run", "blk", "low", "core", F.posexplode("wins").alias("nth", "win"),
                                              F.size("wins").alias("size")))
    shared = park(wins.groupBy("core", "win").agg(F.min("run").alias("r0"), F.max("run").alias("r1"))
                  .filter("r0 <> r1").select("core", "win"))
    # window nth of a block starts low + size - 1 - nth bytes before the block's last anchor offset
    bit = F.expr("shiftleft(1, low + size - 1 - nth)")
    partial = (wins.join(shared, ["core", "win"]).groupBy("run", "blk").agg(F.bit_or(bit).alias("mask")))
    whole = met.filter("same").select("run", "blk", F.lit((1 << BLOCK) - 1).alias("mask")).distinct()
    verdict = park(partial.unionByName(whole).unionByName(
        distinct.filter("n > 1").select("run", F.lit(-1).alias("blk"), F.lit(0).alias("mask"))))
    marks = (held.select("doc_id", "run").distinct().join(verdict, "run").groupBy("doc_id")
             .agg(F.collect_list(F.struct("run", "blk", "mask")).alias("marks")).withColumnRenamed("doc_id", "id"))
    return map_arrow(docs.join(marks.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(marks["id"]), "left"),
                     _cut(gram, width), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
