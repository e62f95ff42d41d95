"""Near duplicates by order min-hash and banded alignment.

The k-mers of a document are its runs of ``GRAM`` words, labelled with their
occurrence number so that repeats count. Each of ``TABLES`` hash functions
takes the ``KEEP`` smallest labelled k-mers and writes them down in text order;
two documents meet in a table when those sequences are equal, which needs the
same k-mers in the same order and so follows edit similarity.

* Documents with the same words are one text: its smallest doc_id stands for
  all copies, and copies are never compared.
* A text is first aligned with the smallest document of a bucket that it meets
  in most tables, then with the smallest ones of its other buckets where that
  left both texts in different classes. All other pairs of a bucket follow, but
  those whose texts are of one class by then, and those that bounds on the two
  similarities rule out. So no link between different
  classes is lost, and a bucket of thousands of texts of one class costs as many
  pairs.
* A pair is a link if the edit distance of its word sequences, found by a
  banded alignment whose band grows up to the allowed distance, is at most
  ``1 - SIMILARITY`` of the longer one and, where ``shingle`` is given, the
  sets of its k-mers have at least that Jaccard similarity; the query and the
  pipeline ask for ``SHINGLE``. Both are exact. Scattered edits fail the k-mers
  long before the alignment, moved blocks only the alignment. A pair of k-mer
  similarity 0.8 meets in no table with probability below 1e-9.
* Classes are the connected components of the links.

Documents without words, or whose text is null, are classes of their own;
texts shorter than a k-mer have one k-mer, the whole text. Rows without doc_id
get a null class. Rows that share a doc_id are judged each by its own words.
Every row of the input has a result row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm import flat
from tavola.llm.common import few, map_arrow, park, table
from tavola.llm.graph import components, merged

GRAM = 5
KEEP = 3
TABLES = 32
SIMILARITY = 0.8
SHINGLE = 0.8
PIECE = 1 << 16
FAR = 1 << 20
CELL_BITS = 10
WORDS = (1 << CELL_BITS) // 64
#: Rows of a few numbers that a whole text, and the alignment of two, count for.
TEXT_ROWS = 4 * TABLES
PAIR_ROWS = 2 * TEXT_ROWS


def labelled(grams: np.ndarray) -> np.ndarray:
    """k-mer codes made distinct by their occurrence number within the text."""
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    again = np.r_[False, s[1:] == s[:-1]]
    if not again.any():
        return grams
    at = np.arange(len(s))
    nth = np.empty(len(s), dtype=np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(again, 0, at))
    return np.where(nth > 0, flat.mix(grams + nth), grams)


def sketch(codes: np.ndarray, multipliers: np.ndarray, gram: int = GRAM, keep: int = KEEP) -> np.ndarray:
    """One hash per table of the smallest labelled k-mers in text order."""
    roll = flat.Rolling(codes, "unit")
    grams = labelled(roll.grams(min(gram, len(codes))))
    picks = []
    for s in range(0, len(grams), PIECE):
        part = grams[s:s + PIECE]
        n = min(keep, len(part))
        h = part[None, :] * multipliers[:, None]
        picks.append(np.argpartition(h, n - 1, axis=1)[:, :n] + s)
    at = np.concatenate(picks, axis=1)
    if len(picks) > 1:
        h = grams[at] * multipliers[:, None]
        at = np.take_along_axis(at, np.argpartition(h, keep - 1, axis=1)[:, :keep], axis=1)
    at.sort(axis=1)
    out = multipliers.copy()
    for c in range(at.shape[1]):
        out = flat.mix(out ^ grams[at[:, c]])
    return out


def _multipliers(tables: int) -> np.ndarray:
    return flat.mix(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def _keys(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every text's word sequence."""
    check = flat.Rolling(flat.mix(codes ^ np.uint64(0x5851F42D4C957F2D)), "byte")
    return flat.Rolling(codes, "unit").ranges(start, end).view(np.int64), check.ranges(start, end).view(np.int64)


def _scan(gram: int, keep: int, tables: int):
    multipliers = _multipliers(tables)

    def fn(batch: pa.RecordBatch):
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            start, end, row = flat.words(data, offsets)
            codes = flat.word_codes(data, start, end)
            first = np.searchsorted(row, np.arange(b - a + 1))
            s, e = first[:-1], first[1:]
            k1, k2 = _keys(codes, s, e)
            bands = [sketch(codes[i:j], multipliers, gram, keep).view(np.int64) if j > i else None
                     for i, j in zip(s.tolist(), e.tolist())]
            yield {"doc_id": batch.column("doc_id").slice(a, b - a), "text_id": batch.column("text_id").slice(a, b - a), "n_words": e - s,
                   "k1": k1, "k2": k2, "bands": pa.array(bands, pa.list_(pa.int64()))}
    return fn


def _codes(batch: pa.RecordBatch):
    """Word codes of every row, and whether its words are those that the row was asked for."""
    for a, b, data, offsets in flat.chunks(batch.column("text")):
        start, end, row = flat.words(data, offsets)
        codes = flat.word_codes(data, start, end)
        first = np.searchsorted(row, np.arange(b - a + 1))
        k1, k2 = _keys(codes, first[:-1], first[1:])
        of = [batch.column(f"of_{k}").slice(a, b - a).to_numpy() for k in ("k1", "k2", "n_words")]
        short = (codes >> np.uint64(33)).astype(np.int32)
        yield {"node": batch.column("node").slice(a, b - a), "same": (k1 == of[0]) & (k2 == of[1]) & (np.diff(first) == of[2]),
               "codes": pa.array([short[i:j].tobytes() for i, j in zip(first[:-1].tolist(), first[1:].tolist())], pa.binary())}


def _banded(a: list[np.ndarray], b: list[np.ndarray], band: int, limit: np.ndarray) -> np.ndarray:
    """Edit distances of pairs, exact where at most ``band``; FAR where over band or limit."""
    n = np.array([len(x) for x in a])
    m = np.array([len(x) for x in b])
    pairs, width = len(a), 2 * band + 1
    rows = int(n.max(initial=0))
    left = np.full((pairs, rows), -1, dtype=np.int32)
    right = np.full((pairs, rows + 3 * band + 2), -2, dtype=np.int32)
    for p in range(pairs):
        left[p, :n[p]] = a[p]
        k = min(m[p], rows + 2 * band)
        right[p, band:band + k] = b[p][:k]
    step = np.arange(width, dtype=np.int32)
    column = step[None, :] - band
    dist = np.where((column >= 0) & (column <= m[:, None]), column, FAR).astype(np.int32)
    out = np.full(pairs, FAR, dtype=np.int64)
    at_end = m - n + band
    inside = (at_end >= 0) & (at_end < width)
    live = inside.copy()
    out[inside & (n == 0)] = m[inside & (n == 0)]
    for i in range(1, rows + 1):
        # cell k of row i is column j = i + k - band; its word of b sits at right[i + k - 1]
        new = dist + (left[:, i - 1:i] != right[:, i - 1:i - 1 + width])
        new[:, :-1] = np.minimum(new[:, :-1], dist[:, 1:] + 1)
        j = i + column
        new = np.where((j >= 0) & (j <= m[:, None]), new, FAR)
        if i <= band:
            new[:, band - i] = i
        dist = np.minimum.accumulate(new - step, axis=1) + step
        done = live & (n == i)
        if done.any():
            out[done] = dist[done, at_end[done]]
            live &= ~done
        if not i % 32:
            live &= dist.min(axis=1) <= np.minimum(limit, band)
            if not live.any():
                break
    return np.where(out <= np.minimum(limit, band), out, FAR)


def distances(a: list[np.ndarray], b: list[np.ndarray], similarity: float) -> np.ndarray:
    """Exact edit distances up to the allowed one, FAR beyond it."""
    long = np.array([max(len(x), len(y)) for x, y in zip(a, b)], dtype=np.int64)
    limit = np.floor((1 - similarity) * long + 1e-9).astype(np.int64)
    out = np.full(len(a), FAR, dtype=np.int64)
    trimmed = []
    for x, y in zip(a, b):
        k = min(len(x), len(y))
        same = x[:k] == y[:k]
        s = k if same.all() else int(np.argmin(same))
        k -= s
        same = x[len(x) - k:][::-1] == y[len(y) - k:][::-1]
        e = k if same.all() else int(np.argmin(same))
        trimmed.append((x[s:len(x) - e], y[s:len(y) - e]))
    todo = np.flatnonzero(np.array([abs(len(x) - len(y)) for x, y in zip(a, b)]) <= limit)
    band = 8
    while len(todo):
        size = np.array([len(trimmed[p][0]) for p in todo])
        todo = todo[np.argsort(size, kind="stable")]
        pairs = max(1, min(256, 400_000 // (2 * band + 1)))
        s = 0
        while s < len(todo):
            group = todo[s:s + pairs]
            longest = [len(trimmed[p][0]) for p in group]
            fit = max(1, int(np.searchsorted(np.arange(1, len(group) + 1) * np.array(longest), 4_000_000, side="right")))
            group = group[:fit]
            got = _banded([trimmed[p][0] for p in group], [trimmed[p][1] for p in group], band, limit[group])
            out[group] = got
            s += len(group)
        todo = todo[(out[todo] == FAR) & (limit[todo] > band)]
        band *= 4
    return out


def shingles(codes: np.ndarray, gram: int) -> np.ndarray:
    """Distinct k-mers of a text, sorted; the whole text if it is shorter."""
    return np.unique(flat.Rolling(flat.mix(codes.astype(np.uint64)), "unit").grams(min(gram, len(codes))))


def alike(a: list[np.ndarray], b: list[np.ndarray], gram: int, similarity: float) -> np.ndarray:
    """Whether the k-mer sets of pairs have at least the Jaccard similarity."""
    out = np.zeros(len(a), dtype=bool)
    for p, (x, y) in enumerate(zip(a, b)):
        x, y = shingles(x, gram), shingles(y, gram)
        if min(len(x), len(y)) >= similarity * max(len(x), len(y)) - 1e-9:
            both = len(np.intersect1d(x, y, assume_unique=True))
            out[p] = both >= similarity * (len(x) + len(y) - both) - 1e-9
    return out


def _verify(similarity: float, gram: int, shingle: float | None):
    def fn(batch: pa.RecordBatch):
        a = [np.frombuffer(x, dtype=np.int32) for x in batch.column("left").to_pylist()]
        b = [np.frombuffer(x, dtype=np.int32) for x in batch.column("right").to_pylist()]
        near = np.arange(len(a)) if shingle is None else np.flatnonzero(alike(a, b, gram, shingle))
        keep = near[distances([a[p] for p in near], [b[p] for p in near], similarity) < FAR]
        yield {"u": batch.column("member").take(pa.array(keep)), "v": batch.column("leader").take(pa.array(keep))}
    return fn


def _links(pairs: DataFrame, codes: DataFrame, similarity: float, gram: int, shingle: float | None) -> DataFrame:
    left = codes.select(F.col("node").alias("member"), F.col("codes").alias("left"))
    right = codes.select(F.col("node").alias("leader"), F.col("codes").alias("right"))
    met = pairs.select("member", "leader").join(left, "member").join(right, "leader")
    return map_arrow(few(met, pairs.count() * PAIR_ROWS), _verify(similarity, gram, shingle), "u long, v long")


def _signature(gram: int):
    """Number of distinct k-mers of a text and the parity of their number in each of 64 * WORDS cells."""
    def fn(batch: pa.RecordBatch):
        size, bits = [], []
        for x in batch.column("codes").to_pylist():
            codes = np.frombuffer(x, dtype=np.int32)
            grams = shingles(codes, gram) if len(codes) else np.zeros(0, np.uint64)
            cells = np.bincount((flat.mix(grams) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS) & 1
            size.append(len(grams))
            bits.append(np.packbits(cells.astype(np.uint8)).view(np.int64))
        bits = np.array(bits)
        yield {"node": batch.column("node"), "size": np.array(size, dtype=np.int64)} | {f"s{i}": bits[:, i] for i in range(WORDS)}
    return fn


def _rest_of_buckets(texts: DataFrame, buckets: DataFrame, done: DataFrame, roots: DataFrame, codes: DataFrame,
                     entries: int, similarity: float, gram: int, shingle: float | None) -> DataFrame:
    """member, leader: the pairs of every bucket's texts that are of different classes, apart from those that are done.

    Only buckets with texts of several classes are joined with themselves, on the bucket, which splits a large one.
    Pairs that cannot be links are left out by bounds: an edit distance is at least the difference of the lengths, and
    a k-mer that only one of two texts holds changes the parity of one cell, so the cells that differ are at most those
    k-mers, which the Jaccard similarity limits.
    """
    near = f"leader < member AND rl <> rm AND abs(nl - nm) <= floor({1 - similarity!r}D * greatest(nl, nm) + 1e-9D)"
    texts = (texts.select("node", "n_words", "bands").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    named = texts.select("node", "root", "n_words", F.explode("bands").alias("band")).join(buckets.filter("n > 2").select("band"), "band")
    several = named.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("band")
    named = park(few(named.join(several, "band", "left_semi"), entries), tidy=True)
    sides = []
    kept = ["size", *[f"s{i}" for i in range(WORDS)]] if shingle is not None else []
    if kept:
        nodes = named.select("node").distinct()
        signed = map_arrow(codes.join(nodes, "node", "left_semi"), _signature(gram), "node long, size long, " + ", ".join(f"s{i} long" for i in range(WORDS)))
        named = park(few(named.join(signed, "node"), entries * WORDS), tidy=True)
        apart = " + ".join(f"bit_count(l_s{i} ^ r_s{i})" for i in range(WORDS))
        near += (f" AND least(l_size, r_size) >= {shingle!r}D * greatest(l_size, r_size) - 1e-6D"
                 f" AND {apart} <= (l_size + r_size) * {1 - 2 * shingle / (1 + shingle)!r}D + 1e-6D")
    for node, end in (("leader", "l"), ("member", "r")):
        short = {"l": ("rl", "nl"), "r": ("rm", "nm")}[end]
        sides.append(named.select("band", F.col("node").alias(node), F.col("root").alias(short[0]), F.col("n_words").alias(short[1]),
                                  *[F.col(c).alias(f"{end}_{c}") for c in kept]))
    pairs = sides[0].join(sides[1], "band").filter(near).select("member", "leader").distinct()
    return park(pairs.join(done, ["member", "leader"], "left_anti"), tidy=True)


def near_duplicates(docs: DataFrame, gram: int = GRAM, keep: int = KEEP, tables: int = TABLES,
                    similarity: float = SIMILARITY, shingle: float | None = None) -> DataFrame:
    """doc_id, rep_id (smallest doc_id with the same words), class_id, one row per input row."""
    return rows_with_classes(docs, gram, keep, tables, similarity, shingle).select("doc_id", "rep_id", "class_id")


def rows_with_classes(docs: DataFrame, gram: int = GRAM, keep: int = KEEP, tables: int = TABLES,
                      similarity: float = SIMILARITY, shingle: float | None = None) -> DataFrame:
    """As ``near_duplicates``, with text_id (a hash of the whole text), node (a number per distinct word sequence,
    null without words) and leads (the row's words are those of the class's first text).

    A doc_id that several rows hold with different words is a text of its own for each of them.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_id"), F.col("text").cast("string"))
    key = ["k1", "k2", "n_words"]
    scanned = park(map_arrow(docs, _scan(gram, keep, tables),
                             "doc_id long, text_id long, n_words long, k1 long, k2 long, bands array<long>"))
    entries = scanned.count() * tables
    texts = (few(scanned.filter("doc_id IS NOT NULL AND n_words > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "bands")).alias("s")), entries)
             .select(*key, F.col("s.doc_id").alias("rep_id"), "s.bands"))
    # numbers in the order of doc_id, unique also where a doc_id is the first of several texts
    texts = park(texts.orderBy("rep_id", *key).withColumn("node", F.monotonically_increasing_id()))
    rows = texts.select("node", F.explode("bands").alias("band"))
    buckets = park(few(rows.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n"))
                       .filter("n > 1").select("band", "leader", "n"), entries))
    pairs = park(few(rows.join(buckets.drop("n"), "band").filter("node <> leader").groupBy(F.col("node").alias("member"), "leader")
                     .agg(F.count("*").alias("met")), entries), tidy=True)
    best = pairs.groupBy("member").agg(F.max(F.struct("met", F.expr("-leader").alias("l"))).alias("b"))
    best = park(few(best.select("member", F.expr("-b.l").alias("leader")), pairs.count()))
    paired = pairs.select(F.col("member").alias("node")).union(pairs.select("leader")).distinct()
    asked = park(few(paired.join(texts.select("node", F.col("rep_id").alias("doc_id"), *[F.col(k).alias(f"of_{k}") for k in key]), "node"), entries))
    whole = entries // tables * TEXT_ROWS
    codes = map_arrow(few(docs.join(asked.hint("shuffle_hash"), "doc_id").drop("text_id"), whole), _codes,
                      "node long, same boolean, codes binary")
    codes = park(few(codes.filter("same").drop("same").dropDuplicates(["node"]), whole), tidy=True)
    first = park(_links(best, codes, similarity, gram, shingle))
    roots = park(components(first))
    named = (pairs.join(best, ["member", "leader"], "left_anti")
             .join(roots.select(F.col("node").alias("member"), F.col("root").alias("rm")), "member", "left")
             .join(roots.select(F.col("node").alias("leader"), F.col("root").alias("rl")), "leader", "left")
             .filter("coalesce(rm, member) <> coalesce(rl, leader)"))
    second = park(_links(park(named.select("member", "leader"), tidy=True), codes, similarity, gram, shingle))
    roots = park(merged(roots, second))
    third = park(_links(_rest_of_buckets(texts, buckets, pairs, roots, codes, entries, similarity, gram, shingle),
                        codes, similarity, gram, shingle))
    final = park(merged(roots, third))
    names = texts.select(F.col("node").alias("root"), F.col("rep_id").alias("class_id"))
    classes = final.join(names, "root").select("node", "root", "class_id")
    return (scanned.select("doc_id", "text_id", *key).join(texts.select(*key, "rep_id", "node"), key, "left")
            .join(classes, "node", "left")
            .withColumn("rep_id", F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(rep_id, doc_id) END"))
            .withColumn("node", F.expr("CASE WHEN doc_id IS NOT NULL THEN node END"))
            .select("doc_id", "rep_id", F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(class_id, rep_id) END").alias("class_id"),
                    "text_id", "node", F.expr("coalesce(root = node, true)").alias("leads")))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=SHINGLE)
