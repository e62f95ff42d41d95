"""Substring dedup with repeated-phrase automata.

A *window* is ``width`` consecutive words of one document; a window recurs in a
document when the same word sequence also starts in a document with a smaller
doc_id. Words covered by a recurring window are removed.

1. Every window belongs to the run of windows that share its anchor, the
   ``phrase``-word sequence in it with the smallest hash. Equal windows have
   equal anchors, so a window can only recur if its anchor phrase does. One
   row per run (about two runs per ``width`` words) is counted, not one per
   window.
2. Phrases met in two documents are confirmed: for every distinct run of such
   a phrase the first document is known; where a phrase has several distinct
   runs, the windows of one copy of each run are compared one by one, and a bit
   mask says which of them an earlier document holds.
3. Each shard of documents (an Arrow chunk of bounded bytes) compiles an
   Aho-Corasick automaton of the confirmed phrases its documents ask for and
   streams the documents through it. Each hit locates an occurrence; the run
   around it tells which words go.

A phrase that a third of all documents hold is one row per document in joins
that Spark may split, and is pre-aggregated in every grouping; no group is
gathered in one task. Documents without doc_id are never compared; a null text
has no words; rows with equal doc_id are one document for the comparison and
keep a result row each.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm import flat
from tavola.llm.common import map_arrow, park, table

WIDTH = 50
PHRASE = 25


def _runs(data, offsets, phrase, width):
    """Word runs of a chunk: (words' starts, ends, rows, codes, runs or None)."""
    start, end, row = flat.words(data, offsets)
    codes = flat.word_codes(data, start, end)
    found = flat.window_runs(codes, row, phrase, width)
    if found is None:
        return start, end, row, codes, None
    roll, grams, anchor, j0, j1 = found
    run = flat.mix(roll.ranges(j0, j1 - 1 + width) ^ (anchor - j0).astype(np.uint64))
    return start, end, row, codes, (roll, grams[anchor].view(np.int64), run.view(np.int64), anchor, j0, j1)


def _scan(phrase: int, width: int):
    def fn(batch: pa.RecordBatch):
        ids = batch.column("doc_id").to_numpy()
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            _, _, row, _, runs = _runs(data, offsets, phrase, width)
            if runs is not None:
                _, kh, sh, _, j0, _ = runs
                yield {"doc_id": ids[a:b][row[j0]], "phrase": kh, "run": sh}
    return fn


def _windows(phrase: int, width: int):
    """Window hashes of the runs that a document is asked for."""
    def fn(batch: pa.RecordBatch):
        ids = batch.column("doc_id").to_numpy()
        want = batch.column("want")
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            _, _, row, _, runs = _runs(data, offsets, phrase, width)
            if runs is None:
                continue
            roll, kh, sh, _, j0, j1 = runs
            part = want.slice(a, b - a)
            asked = part.flatten().to_numpy()
            asker = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            own = flat.mix(sh.view(np.uint64) + row[j0].astype(np.uint64))
            keep = np.isin(own, flat.mix(asked.view(np.uint64) + asker.astype(np.uint64)))
            kh, sh, j0, n = kh[keep], sh[keep], j0[keep], (j1 - j0)[keep]
            if len(n):
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                j = np.repeat(j0, n) + at
                yield {"doc_id": ids[a:b][row[j]], "phrase": np.repeat(kh, n), "run": np.repeat(sh, n),
                       "nth": at.astype(np.int32), "win": roll.ranges(j, j + width).view(np.int64)}
    return fn


def _locate(phrase: int, width: int):
    """Stream a chunk through the automaton of its confirmed phrases; cut the words."""
    def fn(batch: pa.RecordBatch):
        marks = batch.column("marks")
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            start, end, row, codes, runs = _runs(data, offsets, phrase, width)
            gone = np.zeros(len(start) + 1, dtype=np.int64)
            part = marks.slice(a, b - a)
            if runs is not None and len(part.flatten()):
                _, kh, sh, anchor, j0, j1 = runs
                flat_marks = part.flatten()
                asker = np.repeat(np.arange(b - a), np.diff(part.fill_null([]).offsets.to_numpy()))
                key = flat.mix(flat_marks.field("run").to_numpy().view(np.uint64) + asker.astype(np.uint64))
                mask = flat_marks.field("mask").to_numpy()
                order = np.argsort(key)
                own = flat.mix(sh.view(np.uint64) + row[j0].astype(np.uint64))
                at = np.minimum(np.searchsorted(key[order], own), len(key) - 1)
                hit = key[order][at] == own
                bits = np.where(hit, mask[order][at], 0)
                located = _automaton_hits(codes, row, anchor[hit], phrase)
                for r in np.flatnonzero(hit & located[anchor]):
                    if bits[r] == -1:
                        gone[j0[r]] += 1
                        gone[j1[r] - 1 + width] -= 1
                    else:
                        js = j0[r] + np.flatnonzero([(int(bits[r]) >> i) & 1 for i in range(j1[r] - j0[r])])
                        gone[js] += 1
                        np.add.at(gone, js + width, -1)
            removed = np.cumsum(gone[:-1]) > 0
            first = np.searchsorted(row, np.arange(b - a + 1))
            raw = data.tobytes()
            kept = []
            for i in range(b - a):
                w = raw[offsets[i]: offsets[i + 1]].split()
                cut = removed[first[i]: first[i + 1]]
                kept.append(b" ".join([x for x, c in zip(w, cut.tolist()) if not c] if cut.any() else w))
            total = np.concatenate([[0], np.cumsum(removed)])
            yield {"doc_id": batch.column("doc_id").slice(a, b - a),
                   "n_words": first[1:] - first[:-1], "n_removed": total[first[1:]] - total[first[:-1]],
                   "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
    return fn


def _automaton_hits(codes: np.ndarray, row: np.ndarray, anchors: np.ndarray, phrase: int) -> np.ndarray:
    """Which word positions start a confirmed phrase, by one Aho-Corasick pass.

    Words become 32-bit symbols of the automaton; a row break is a symbol that
    no phrase holds.
    """
    found = np.zeros(len(codes), dtype=bool)
    if not len(anchors):
        return found
    symbols = (codes >> np.uint64(33)).astype(np.int64) + 1
    auto = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for at in anchors.tolist():
        auto.add_word(tuple(symbols[at: at + phrase].tolist()))
    auto.make_automaton()
    asking = np.unique(row[anchors])
    first = np.searchsorted(row, asking)
    last = np.searchsorted(row, asking + 1)
    for s, e in zip(first.tolist(), last.tolist()):
        ends = [s + i for i, _ in auto.iter(tuple(symbols[s:e].tolist()))]
        found[np.array(ends, dtype=np.int64) - (phrase - 1)] = True
    return found


def confirm_passages(docs: DataFrame, phrase: int = PHRASE, width: int = WIDTH) -> DataFrame:
    """Per document the runs to remove: doc_id, phrase, run, mask (-1: the whole run)."""
    known = docs.filter("doc_id IS NOT NULL")
    runs = map_arrow(known, _scan(phrase, width), "doc_id long, phrase long, run long")
    runs = park(runs)
    recurring = park(runs.groupBy("phrase").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                     .filter("a < b").select("phrase"))
    held = park(runs.join(recurring, "phrase"), tidy=True)
    distinct = park(held.groupBy("phrase", "run").agg(F.min("doc_id").alias("first")))
    several = distinct.groupBy("phrase").agg(F.count("*").alias("n")).filter("n > 1").select("phrase")
    ask = (distinct.join(several, "phrase").groupBy("first").agg(F.collect_list("run").alias("want"))
           .withColumnRenamed("first", "doc_id"))
    wins = park(map_arrow(known.join(ask.hint("shuffle_hash"), "doc_id"), _windows(phrase, width),
                          "doc_id long, phrase long, run long, nth int, win long"), tidy=True)
    shared = park(wins.groupBy("phrase", "win").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                  .filter("a < b").select("phrase", "win", "a"))
    masks = (wins.join(shared, ["phrase", "win"]).filter("doc_id > a").groupBy("phrase", "run")
             .agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask")))
    verdict = park(distinct.join(masks, ["phrase", "run"], "left"))
    return (held.distinct().join(verdict, ["phrase", "run"])
            .withColumn("mask", F.expr("CASE WHEN doc_id > first THEN -1L ELSE mask END"))
            .filter("mask IS NOT NULL").select("doc_id", "phrase", "run", "mask"))


def substring_dedup(docs: DataFrame, phrase: int = PHRASE, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) per input row.

    ``width - phrase`` must stay below 63, the bits of a run's mask.
    """
    if not 0 < width - phrase < 63:
        raise ValueError("phrase must be shorter than width by 1 to 62 words")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marks = confirm_passages(docs, phrase, width)
    marks = marks.groupBy("doc_id").agg(F.collect_list(F.struct("run", "mask")).alias("marks"))
    return map_arrow(docs.join(marks.hint("shuffle_hash"), "doc_id", "left"), _locate(phrase, width),
                     "doc_id long, n_words long, n_removed long, kept_text string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
