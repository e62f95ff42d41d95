"""Ranked lexical search for many items at once, with shared term sets evaluated once.

A score is a sum over an item's terms, so items that share terms share partial
sums. The search runs in four steps:

1. *Mining.* Terms that stand in exactly the same items become one atom. Atoms
   are ordered by how many items hold them (in powers of two), then by their
   first item, so that atoms which occur together are neighbours. Every item's
   atoms are then paired over dyadic ranges of this order, level by level, and
   equal pairs become one node: a node is a set of terms, met in one or many
   items. The nodes form a directed acyclic graph whose roots are the items.
   ``sharing_plan`` returns it as a table.
2. *Postings.* One pass over the whole texts counts the terms of every document
   and the occurrences of the items' terms in it.
3. *Accumulators.* A task takes its documents block by block and holds one sum
   per (node, document): atoms add their terms' contributions, each inner node
   is the sum of its two children and is computed once for all items above it.
4. *Ranking.* A task keeps its ``top`` best documents of every item; a window
   per item picks the best of all tasks.

Items are dealt by hash to blocks of about ``BLOCK_TERMS`` (item, term) pairs;
graph and vocabulary of one block are what a task holds, whatever the number of
items, and blocks are searched one after another. Terms are compared by a 64-bit
hash and then byte by byte.

Terms are maximal runs of ASCII letters and digits and of characters beyond
ASCII; only A-Z are lower-cased. A null or empty text has no terms. Rows of the
documents that share a doc_id are documents each, with a result row each; a row
without doc_id counts in the statistics and is never returned. Rows of the items
that share an item_id are one item, a row without item_id is none. Items without
a term, or whose terms no document holds, have no rows; equal scores rank by
doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm import flat
from tavola.llm.common import discard, map_arrow, park, table

TOP = 50
BLOCK_TERMS = 1_000_000
#: Accumulators of a block of documents: so many 64-bit sums at once.
HELD_SUMS = 1 << 22

_TERM = np.zeros(256, dtype=bool)
_TERM[0x80:] = True
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _TERM[ord(_a):ord(_b) + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of the items."""
    low = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (items.filter("item_id IS NOT NULL")
            .select(F.col("item_id").cast("long"), F.explode(F.split(low, SEPARATORS)).alias("term"))
            .filter("term <> ''").distinct())


def _mine(table: pa.Table) -> pa.Table:
    """The graph of one block: see ``sharing_plan``."""
    block = table.column("block")[0].as_py()
    coded = table.column("term").combine_chunks().dictionary_encode()
    words = coded.dictionary.to_pylist()
    term = coded.indices.to_numpy().astype(np.int64)
    ids, item = np.unique(table.column("item_id").to_numpy(), return_inverse=True)
    order = np.lexsort((item, term))
    term, item = term[order], item[order]
    cut = np.flatnonzero(np.r_[True, term[1:] != term[:-1], True])
    sets: dict[bytes, list[int]] = {}
    for t, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        sets.setdefault(item[a:b].tobytes(), []).append(t)
    held = [np.frombuffer(k, dtype=item.dtype) for k in sets]
    groups = list(sets.values())
    rank = sorted(range(len(held)), key=lambda i: (-len(held[i]).bit_length(), int(held[i][0]), min(words[t] for t in groups[i])))
    rows = [{"node": n, "level": 0, "left": None, "right": None, "terms": sorted(words[t] for t in groups[i]),
             "n_items": len(held[i]), "item_id": None} for n, i in enumerate(rank)]
    # (item, position, node) of every item's atoms; a level halves the positions
    at = np.concatenate([held[i] for i in rank])
    pos = np.repeat(np.arange(len(rank)), [len(held[i]) for i in rank])
    order = np.lexsort((pos, at))
    at, pos = at[order], pos[order]
    node, level, total = pos.copy(), 0, len(rank)
    while pos.any():
        level, pos = level + 1, pos >> 1
        twin = np.zeros(len(at), dtype=bool)
        twin[1:] = (at[1:] == at[:-1]) & (pos[1:] == pos[:-1])
        right = np.flatnonzero(twin)
        if len(right):
            pairs, which, n = np.unique(np.stack([node[right - 1], node[right]], axis=1), axis=0, return_inverse=True,
                                        return_counts=True)
            rows += [{"node": total + k, "level": level, "left": p[0], "right": p[1], "terms": None, "n_items": c, "item_id": None}
                     for k, (p, c) in enumerate(zip(pairs.tolist(), n.tolist()))]
            node[right - 1] = total + which.reshape(-1)
            total += len(pairs)
            at, pos, node = at[~twin], pos[~twin], node[~twin]
    rows += [{"node": int(n), "level": None, "left": None, "right": None, "terms": None, "n_items": 1, "item_id": int(ids[i])}
             for i, n in zip(at, node)]
    for r in rows:
        r["block"] = block
    return pa.Table.from_pylist(rows, schema=_PLAN)


_PLAN = pa.schema([("block", pa.int32()), ("node", pa.int32()), ("level", pa.int32()), ("left", pa.int32()), ("right", pa.int32()),
                   ("terms", pa.list_(pa.string())), ("n_items", pa.int32()), ("item_id", pa.int64())])


def sharing_plan(pairs: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The query-sharing graph of distinct (item_id, term) rows.

    Atoms have level 0 and ``terms``; inner nodes have ``left`` and ``right``,
    nodes of the same block and a lower level; a row with ``item_id`` names the
    node that holds the item's whole term set. ``n_items`` counts the items in
    which a node was met at its level.
    """
    blocks = max(1, -(-pairs.count() // block_terms))
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(
        _mine, "block int, node int, level int, left int, right int, terms array<string>, n_items int, item_id long")


class Vocabulary:
    """Terms as sorted hashes with their bytes, for lookups in flat buffers."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        end = np.cumsum(size)
        code = flat.word_codes(data, end - size, end)
        order = np.argsort(code)
        self.code, self.number = code[order], order.astype(np.int32)
        self.data, self.start, self.size = data, (end - size)[order], size[order]
        if len(np.unique(code)) < len(code):
            raise ValueError("two terms share a 64-bit hash")

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words of a lower-cased buffer are terms, and their numbers."""
        code = flat.word_codes(data, start, end)
        slot = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        hit = np.flatnonzero((self.code[slot] == code) & (self.size[slot] == end - start))
        if not len(hit):
            return hit, self.number[:0]
        slot, size = slot[hit], (end - start)[hit]
        first = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(first, size)
        same = data[np.repeat(start[hit], size) + step] == self.data[np.repeat(self.start[slot], size) + step]
        whole = np.logical_and.reduceat(same, first)
        return hit[whole], self.number[slot[whole]]


def _words(data: np.ndarray, offsets: np.ndarray):
    """Start, end and row of every term of the texts in a buffer."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _TERM[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n, term, tf of every row with a term: its number of terms, and numbers and occurrences of the given ones."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    vocabulary = Vocabulary(terms)

    def fn(batch: pa.RecordBatch):
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            data = _LOWER[data]
            start, end, row = _words(data, offsets)
            n = np.bincount(row, minlength=b - a)
            hit, number = vocabulary.find(data, start, end)
            key, tf = np.unique(row[hit] << 32 | number, return_counts=True)
            bounds = np.searchsorted(key, np.arange(b - a + 1) << 32).astype(np.int32)
            some = pa.array(n > 0)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))).filter(some)
                     for x in (key & 0xFFFFFFFF, tf)]
            yield {"doc_id": batch.column("doc_id").slice(a, b - a).filter(some), "n": n[n > 0], "term": lists[0], "tf": lists[1]}

    return map_arrow(docs, fn, "doc_id long, n long, term array<int>, tf array<int>")


class Search:
    """One block's graph as arrays, and the accumulators over blocks of documents."""

    def __init__(self, plan: list, terms: list[str], weight: dict[int, int]):
        """``plan``: rows of ``sharing_plan`` of one block; ``weight`` by term number."""
        number = {t: k for k, t in enumerate(terms)}
        self.weight = np.zeros(len(terms), dtype=np.int64)
        for k, w in weight.items():
            self.weight[k] = w
        self.atom = np.zeros(len(terms), dtype=np.int64)
        levels: dict[int, list] = {}
        roots = []
        self.nodes = 0
        for r in plan:
            if r.item_id is not None:
                roots.append((r.item_id, r.node))
                continue
            self.nodes = max(self.nodes, r.node + 1)
            if r.level == 0:
                for t in r.terms:
                    self.atom[number[t]] = r.node
            else:
                levels.setdefault(r.level, []).append((r.node, r.left, r.right))
        self.levels = [np.array(levels[k], dtype=np.int64).T for k in sorted(levels)]
        self.items, self.roots = np.array(sorted(roots), dtype=np.int64).reshape(-1, 2).T
        self.width = max(1, min(4096, HELD_SUMS // max(1, self.nodes)))

    def scores(self, doc: np.ndarray, term: np.ndarray, part: np.ndarray, n: int) -> np.ndarray:
        """Item by document scores of ``n`` documents from their terms' contributions."""
        sums = np.zeros((self.nodes, n), dtype=np.int64)
        np.add.at(sums.reshape(-1), self.atom[term] * n + doc, part)
        for node, left, right in self.levels:
            sums[node] = sums[left] + sums[right]
        return sums[self.roots]


def _best(item, score, doc, top):
    """Positions of the ``top`` best rows of every item."""
    order = np.lexsort((doc, -score, item))
    first = np.searchsorted(item[order], np.arange(item.max(initial=-1) + 1))
    nth = np.arange(len(order)) - first[item[order]] if len(order) else order
    return order[nth < top]


def rank(postings: DataFrame, search: Search, top: int) -> DataFrame:
    """item_id, doc_id, score: the ``top`` best documents of every item in each task.

    ``postings`` has doc_id, m, term, tf.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = "item_id long, doc_id long, score long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        n_items = len(search.items)
        have = [np.zeros(0, dtype=np.int64)] * 3  # item number, score, doc_id
        worst = np.zeros(n_items, dtype=np.int64)
        worst_doc = np.full(n_items, np.iinfo(np.int64).min)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            m = batch.column("m").to_numpy()
            bounds = batch.column("term").offsets.to_numpy().astype(np.int64)
            bounds = bounds - bounds[0]
            terms = batch.column("term").flatten().to_numpy()
            tfs = batch.column("tf").flatten().to_numpy().astype(np.int64)
            for a in range(0, len(ids), search.width):
                b = min(a + search.width, len(ids))
                term, tf = terms[bounds[a]:bounds[b]], tfs[bounds[a]:bounds[b]]
                doc = np.repeat(np.arange(b - a), np.diff(bounds[a:b + 1]))
                part = search.weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[a:b][doc]))
                score = search.scores(doc, term, part, b - a)
                better = (score > worst[:, None]) | ((score == worst[:, None]) & (ids[a:b][None, :] < worst_doc[:, None]))
                item, col = np.nonzero(better & (score > 0))
                if not len(item):
                    continue
                have = [np.concatenate([x, y]) for x, y in zip(have, (item, score[item, col], ids[a:b][col]))]
                keep = _best(*have, top)
                have = [x[keep] for x in have]
                count = np.bincount(have[0], minlength=n_items)
                last = np.cumsum(count) - 1
                full = count == top
                worst[full], worst_doc[full] = have[1][last[full]], have[2][last[full]]
        yield pa.RecordBatch.from_arrays([pa.array(search.items[have[0]]), pa.array(have[2]), pa.array(have[1])], schema=arrow)

    return postings.select("doc_id", "m", "term", "tf").mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``top`` best documents with a score above 0."""
    pairs = park(item_terms(items))
    plan = park(sharing_plan(pairs, block_terms))
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for block in sorted(r.block for r in plan.select("block").distinct().collect()):
        graph = plan.filter(F.col("block") == block).collect()  # bounded by block_terms
        terms = sorted(t for r in graph for t in r.terms or ())
        listed = park(postings(docs, terms))
        n, length = listed.agg(F.count("*"), F.sum("n")).first()
        if not n:
            discard(listed)
            continue
        weight = (listed.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
                  .select("term", F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1))).cast("long").alias("w")))
        search = Search(graph, terms, {r.term: r.w for r in weight.collect()})  # bounded by the block's vocabulary
        scored = listed.filter("doc_id IS NOT NULL AND size(term) > 0").withColumn(
            "m", F.lit(50) + F.expr(f"(50 * n * {n}L) div {length}L"))
        found = found.unionByName(park(rank(scored, search, top)))
        discard(listed)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_shared_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
