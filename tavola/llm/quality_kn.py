"""Quality classifier: interpolated modified Kneser-Ney model of trusted text.

The model is a byte n-gram of order 4 over all ``BYTES`` bytes. It is trained on
labelled documents of good quality that are not toxic, all of them. In every
language half of their ids, by hash, are for counting, half (never counted, the
odd one too) for thresholds.

* Counts are sharded by n-gram; continuation counts, context totals, the
  discounts' count-of-counts and the discounted shares come from groupings and
  joins of the sharded counts. The result has a number for every n-gram seen in
  trusted text, which every task is sent: it grows with the kinds of four bytes,
  not with the text.
* A task keeps the orders below the highest as a table of all their n-grams and
  the seen n-grams of the highest order sorted (``Lookup``).
* Every document is read whole. Its cross entropy H (log10 per byte) gives the
  perplexity 10**H; (H - mean of its language) * sqrt(min(n, 1024) / 1024) is
  comparable between lengths. A document is kept if that is at most the
  language's ``QUANTILE`` over held-out trusted documents, times ``SLACK``.
* A quantile of few rows says little. With n held-out rows it is at least its
  mean with the quantile of all languages' spreads, weighted n to
  1 / (1 - ``QUANTILE``), and the limit grows by sqrt(1 + 1 / n) for the error
  of the language's mean.
* Documents without a language are judged by the mean and spread of all.

Null and empty texts have no perplexity and are not kept. Nothing is known of a
language without held-out documents: its texts that are not empty are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm import flat
from tavola.llm.common import map_arrow, park, table

ORDER = 4
BYTES = 256
#: Symbols of a model whose table is written out in full, if nothing else is asked for.
ALPHABET = 48
QUANTILE = 0.995
SLACK = 1.2
STEADY_BYTES = 1024
RANGE_BITS = 10
_lookups: dict[str, "Lookup"] = {}


def trusted_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, l (language), h (hash), nth (place by hash among the language's ids, from 1) of all trusted documents.

    The ids of a language are numbered in ranges of the hash, and each range on from those before it.
    """
    good = labels.filter("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct()
    ids = park(docs.select("doc_id", "lang").join(good, "doc_id").groupBy("doc_id").agg(F.min("lang").alias("l"))
               .withColumn("h", F.xxhash64("doc_id")).withColumn("r", F.shiftright("h", 64 - RANGE_BITS)))
    sizes = ids.groupBy("l", "r").agg(F.count("*").alias("n"))  # at most 2**RANGE_BITS rows a language
    before = F.sum("n").over(Window.partitionBy("l").orderBy("r")) - F.col("n")
    sizes = sizes.select(F.col("l").alias("_l"), F.col("r").alias("_r"), before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("l", "r").orderBy("h", "doc_id")) + F.col("before")
    return ids.join(sizes, F.expr("l <=> _l AND r = _r")).select("doc_id", "l", "h", nth.alias("nth"))


def trusted_sample(docs: DataFrame, labels: DataFrame, sample: int | None = None, floor: int = 0) -> DataFrame:
    """doc_id, lang, text, train of the trusted labelled documents: all, or of at most ``sample`` ids, those with the
    smallest hashes of all after the ``floor`` smallest of every language."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    ids = trusted_ids(docs, labels)
    if sample is not None:
        few = ids.filter(F.col("nth") <= floor)
        ids = few.union(ids.orderBy("h", "doc_id").limit(sample)).distinct()
        ids = ids.orderBy(F.least("nth", F.lit(floor + 1)), "h", "doc_id").limit(sample)
    return park(docs.join(park(ids.select("doc_id", F.expr("nth % 2 = 0").alias("train"))), "doc_id"))


def alphabet(texts: DataFrame, size: int = ALPHABET) -> np.ndarray:
    """Symbol of each of the 256 bytes, by its largest share in a language (column lang, if there is one).

    With a ``size`` of 256 every byte has its own; with less, the rarer bytes share one and those never seen another.
    """
    def fn(batch: pa.RecordBatch):
        names = batch.column("lang").dictionary_encode()
        index = names.indices.fill_null(len(names.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.zeros((len(names.dictionary) + 1) * 256, dtype=np.int64)
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            total += np.bincount(np.repeat(index[a:b], np.diff(offsets)) * 256 + data, minlength=len(total))
        at = np.flatnonzero(total)
        langs = [*names.dictionary.to_pylist(), None]
        yield {"lang": [langs[i] for i in at // 256], "byte": (at % 256).astype(np.int32), "n": total[at]}
    lang = F.col("lang").cast("string") if "lang" in texts.columns else F.lit(None).cast("string").alias("lang")
    counts = map_arrow(texts.select(lang, "text"), fn, "lang string, byte int, n long").groupBy("lang", "byte").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    rows = (counts.withColumn("share", share).groupBy("byte").agg(F.max("share").alias("share"))
            .orderBy(F.desc("share"), "byte").collect())  # 256 rows at most
    ranked = [r["byte"] for r in rows]
    symbol = np.full(256, size - 1, dtype=np.uint32)
    if size >= BYTES:
        ranked += sorted(set(range(256)) - set(ranked))
        symbol[ranked] = np.arange(256)
    else:
        symbol[ranked] = np.minimum(np.arange(len(ranked)), size - 2)
    return symbol


def _grams(symbol: np.ndarray, data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Code of the n-gram that ends at every byte; line breaks stand before a text."""
    sym = symbol[data]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    code = sym.copy()
    for k in range(1, ORDER):
        before = np.full(len(data), symbol[10], dtype=np.uint32)
        before[k:] = sym[:-k]
        before[place < k] = symbol[10]
        code += before * np.uint32(size ** k)
    return code


def count_grams(texts: DataFrame, symbol: np.ndarray, size: int = ALPHABET) -> DataFrame:
    """gram, n over all the texts, sharded by gram."""
    def fn(batch: pa.RecordBatch):
        for _, _, data, offsets in flat.chunks(batch.column("text")):
            if len(data):
                gram, n = np.unique(_grams(symbol, data, offsets, size), return_counts=True)
                yield {"gram": gram.astype(np.int64), "n": n.astype(np.int64)}
    return park(map_arrow(texts.select("text"), fn, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))


def estimate(counts: DataFrame, size: int = ALPHABET) -> dict[str, np.ndarray]:
    """Discounted shares of seen n-grams and back-off weights of contexts, of every order."""
    by_order = {ORDER: counts}
    for o in range(ORDER - 1, 0, -1):
        by_order[o] = park(by_order[o + 1].groupBy(F.expr(f"gram % {size ** o}").alias("gram"))
                           .agg(F.count("*").alias("n")))
    parts = []
    for o, c in by_order.items():
        few = {r["n"]: r["k"] for r in c.filter("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
        y = few.get(1, 0) / max(few.get(1, 0) + 2 * few.get(2, 0), 1)
        d = [min(max(j - (j + 1) * y * few.get(j + 1, 0) / max(few.get(j, 0), 1), 0.05), float(j)) for j in (1, 2, 3)]
        cut = f"CASE n WHEN 1 THEN {d[0]!r}D WHEN 2 THEN {d[1]!r}D ELSE {d[2]!r}D END"
        c = c.withColumn("context", F.expr(f"gram div {size}")).withColumn("cut", F.expr(cut))
        contexts = park(c.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("held")))
        parts.append(c.join(contexts, "context").select(F.lit(o).cast("tinyint").alias("order"), F.lit(True).alias("seen"), "gram",
                                                        F.expr("(n - cut) / total").alias("p")))
        parts.append(contexts.select(F.lit(o).cast("tinyint"), F.lit(False), "context", F.expr("held / total")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    t = rows.toArrow()  # at most two rows for every n-gram seen in trusted text
    return {"order": t["order"].to_numpy(), "seen": t["seen"].to_numpy(), "gram": t["gram"].to_numpy().astype(np.uint32),
            "p": t["p"].to_numpy().astype(np.float32)}


def dense(model: dict[str, np.ndarray], size: int = ALPHABET, order: int = ORDER) -> np.ndarray:
    """log10 probability of every ``order``-gram's last symbol after the symbols before it."""
    low = np.full(size, 1.0 / size, dtype=np.float32)
    for o in range(1, order + 1):
        at = model["order"] == o
        seen = at & model["seen"]
        rest = at & ~model["seen"]
        weight = np.ones(size ** (o - 1), dtype=np.float32)
        weight[model["gram"][rest]] = model["p"][rest]
        # the lower order leaves out the first symbol of the context
        p = weight * low if o == 1 else (weight.reshape(size, -1, 1) * low.reshape(1, -1, size)).reshape(-1)
        p[model["gram"][seen]] += model["p"][seen]
        low = p
    return np.log10(low, out=low)


class Lookup:
    """log10 probability of any n-gram's last symbol, without a cell for those never seen."""

    def __init__(self, model: dict[str, np.ndarray], size: int):
        self.size = size
        self.low = dense(model, size, ORDER - 1)
        top = model["order"] == ORDER
        seen, rest = np.flatnonzero(top & model["seen"]), top & ~model["seen"]
        self.weight = np.zeros(size ** (ORDER - 1), dtype=np.float32)
        self.weight[model["gram"][rest]] = np.log10(model["p"][rest])
        seen = seen[np.argsort(model["gram"][seen])]
        self.gram = model["gram"][seen]
        self.logp = np.log10(model["p"][seen] + 10 ** self._unseen(self.gram))

    def _unseen(self, gram: np.ndarray) -> np.ndarray:
        return self.weight[gram // np.uint32(self.size)] + self.low[gram % np.uint32(self.size ** (ORDER - 1))]

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        out = self._unseen(gram)
        if len(self.gram):
            at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
            hit = self.gram[at] == gram
            out[hit] = self.logp[at[hit]]
        return out


def score(docs: DataFrame, symbol: np.ndarray, model: dict[str, np.ndarray], carry: list[str], size: int = BYTES) -> DataFrame:
    """The columns ``carry`` of every row, with n_bytes and entropy (log10 per byte, null if empty)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((symbol, model))
    name = str(id(shared)) + spark.sparkContext.applicationId
    docs = docs.withColumn("text", F.col("text").cast("string"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def fn(batch: pa.RecordBatch):
        if name not in _lookups:
            _lookups.clear()
            _lookups[name] = Lookup(shared.value[1], size)
        lookup, symbols = _lookups[name], shared.value[0]
        for a, b, data, offsets in flat.chunks(batch.column("text")):
            total = np.zeros(len(data) + 1)
            if len(data):
                np.cumsum(lookup(_grams(symbols, data, offsets, size)), dtype=np.float64, out=total[1:])
            n = np.diff(offsets)
            h = -np.diff(total[offsets]) / np.maximum(n, 1)
            yield {c: batch.column(c).slice(a, b - a) for c in carry} | {
                "n_bytes": n, "entropy": pa.array(h, mask=n == 0)}

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carry) + ", n_bytes long, entropy double"
    used = list(dict.fromkeys([*carry, "text"]))
    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in used]), fn, schema)


def thresholds(scored: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """lang, mean, high: one row per language of the held-out sample; a null lang row for all."""
    good = scored.filter("entropy IS NOT NULL AND lang IS NOT NULL")
    means = good.groupBy("lang").agg(F.avg("entropy").alias("mean"), F.count("*").alias("rows"))
    z = good.join(F.broadcast(means), "lang").withColumn("z", _steady())
    at, prior = F.lit(quantile), 1 / (1 - quantile)
    pooled = z.filter("rows > 1").agg(F.percentile(F.expr("z * sqrt(rows / (rows - 1))"), at).alias("pooled"))
    by = z.groupBy("lang", "mean", "rows").agg(F.percentile("z", at).alias("own")).join(F.broadcast(pooled), F.lit(True), "left")
    high = F.expr(f"greatest(own, (rows * own + {prior!r}D * pooled) / (rows + {prior!r}D)) * sqrt(1 + 1 / rows)")
    by = by.select("lang", "mean", F.when(F.col("pooled").isNotNull(), high * slack).alias("high"))
    overall = good.agg(F.avg("entropy").alias("mean"))
    rest = good.join(F.broadcast(overall), F.lit(True)).withColumn("z", _steady()).agg(
        F.first("mean").alias("mean"), (F.percentile("z", at) * slack).alias("high"))
    return by.unionByName(rest.select(F.lit(None).cast("string").alias("lang"), "mean", "high"))


def _steady():
    return F.expr(f"(entropy - mean) * sqrt(least(n_bytes, {STEADY_BYTES}) / {float(STEADY_BYTES)})")


def classify(docs: DataFrame, labels: DataFrame, carry: list[str], sample: int | None = None,
             quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """The columns ``carry`` of every row with n_bytes, perplexity and keep.

    ``docs`` needs doc_id, lang and text; ``carry`` must hold lang. Columns of
    ``docs`` named like a result column are not carried.
    """
    carry = [c for c in carry if c not in ("n_bytes", "entropy", "perplexity", "keep")]
    chosen = trusted_sample(docs, labels, sample)
    symbol = alphabet(chosen.filter("train"), BYTES)
    model = estimate(count_grams(chosen.filter("train"), symbol, BYTES), BYTES)
    limits = park(thresholds(score(chosen.filter("NOT train"), symbol, model, ["lang"])))
    limits = limits.select(F.col("lang").alias("_lang"), F.struct("mean", "high").alias("_limit"))
    rest = limits.filter("_lang IS NULL").select(F.col("_limit").alias("_rest"))
    scored = score(docs, symbol, model, carry)
    judged = (scored.join(F.broadcast(limits.filter("_lang IS NOT NULL")), F.col("lang") == F.col("_lang"), "left")
              .join(F.broadcast(rest), F.lit(True), "left")
              .withColumn("_l", F.when(F.col("lang").isNull(), F.col("_rest")).otherwise(F.col("_limit"))).withColumn("mean", F.col("_l.mean"))
              .withColumn("_z", _steady()))
    keep = F.expr("entropy IS NOT NULL AND coalesce(_z <= _l.high, true)")
    return judged.select(*[F.col(f"`{c}`") for c in carry], "n_bytes", F.pow(F.lit(10.0), "entropy").alias("perplexity"),
                         keep.alias("keep"))


def op10_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return classify(docs, labels, ["doc_id", "lang"])
