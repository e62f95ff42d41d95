"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts become tokens (runs of letters and digits). A token that starts with a
digit is the placeholder ``<num>``, a capitalised word ``<name>``, a unit of
measure ``<unit>``; every other token is its lower-case self. A window is
``WINDOW`` template tokens (a whole item if it is shorter, from ``SHORTEST``
tokens on); windows of an item with fewer than ``LITERALS`` plain words say too
little and are not indexed.

Documents' and items' windows meet in a hash join. Hits on one diagonal (same
distance between the positions) are one occurrence. Its aligned tokens are read
again from the document: the templates must agree, and the slots must be
consistent, i.e. each item value is replaced by one document value throughout.
An occurrence may so repeat the item word for word or with other numbers, names
and units. Nothing is capped; the windows of the items are broadcast only up to
``BROADCAST_WINDOWS`` of them, a join by hash takes more.

Null or empty texts have no windows; rows without doc_id or item_id are not
searched; items of under ``SHORTEST`` tokens are never found. Rows that share a
doc_id are searched each and reported once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm.common import park, table

WINDOW = 13
SHORTEST = 5
LITERALS = 5
BROADCAST_WINDOWS = 2_000_000
# Units of measure that become a placeholder.
UNITS = ("cm", "days", "dollars", "euros", "feet", "gallons", "grams", "hours", "inches", "kg", "kilograms", "kilometers",
         "km", "lbs", "liters", "litres", "meters", "metres", "miles", "minutes", "ml", "mm", "months", "ounces", "percent",
         "pounds", "seconds", "tons", "weeks", "yards", "years")


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[^\\p{L}\\p{N}]+"), "")


def template(words: Column) -> Column:
    def one(t: Column) -> Column:
        low, rest = F.lower(t), F.substring(t, 2, 1 << 30)
        return (F.when((t >= "0") & (t < ":"), "<num>")
                .when(low == t, F.when(t.isin(*UNITS), "<unit>").otherwise(t))
                .when((rest != "") & (F.lower(rest) == rest), "<name>").otherwise(low))
    return F.transform(words, one)


def _windows(words: Column, length: int) -> Column:
    """Hashes of all windows of a length, in order."""
    at = F.when(F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - (length - 1)))
    return F.transform(at, lambda i: F.xxhash64(F.slice(words, i, length)))


def index_items(items: DataFrame) -> DataFrame:
    """item_id, raw, form, length, at, win: the windows of every item worth indexing."""
    rows = (items.filter("item_id IS NOT NULL")
            .select(F.col("item_id").cast("long"), tokens(F.col("text").cast("string")).alias("raw"))
            .withColumn("form", template(F.col("raw"))).filter(F.size("form") >= SHORTEST)
            .withColumn("length", F.least(F.size("form"), F.lit(WINDOW))))
    rows = rows.withColumn("at", F.explode(F.expr("sequence(1, size(form) - length + 1)")))
    rows = rows.withColumn("window", F.expr("slice(form, at, length)"))
    literal = F.size(F.filter("window", lambda t: ~t.startswith("<")))
    return park(rows.filter(literal >= LITERALS).withColumn("win", F.xxhash64("window")).drop("window"))


def occurrences(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Aligned finds: doc_id, item_id, shift, first, last (item tokens), n_windows, n_slots, n_changed, consistent."""
    docs = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    index = index_items(items)
    lengths = sorted(r["length"] for r in index.select("length").distinct().collect()) or [WINDOW]  # at most WINDOW values
    keys = index.select("win", "length", "item_id", "at")
    if keys.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    form = docs.select("doc_id", template(tokens(F.col("text"))).alias("form"))
    hits = None
    for length in lengths:
        wins = form.select("doc_id", F.posexplode(_windows(F.col("form"), length)).alias("pos", "win"))
        part = wins.join(keys.filter(F.col("length") == length), "win").select(
            "doc_id", "item_id", (F.col("pos") + 1 - F.col("at")).alias("shift"), "at", "length")
        hits = part if hits is None else hits.unionByName(part)
    found = park(hits.groupBy("doc_id", "item_id", "shift").agg(
        F.countDistinct("at").alias("n_windows"), F.min("at").alias("first"), F.max(F.expr("at + length - 1")).alias("last")))
    by_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift", "n_windows", "first", "last")).alias("f"))
    read = (docs.join(by_doc.hint("shuffle_hash"), "doc_id").withColumn("raw", tokens(F.col("text")))
            .select("doc_id", "raw", F.explode("f").alias("f"))
            .select("doc_id", "f.*", F.expr("slice(raw, f.first + f.shift, f.last - f.first + 1)").alias("theirs")))
    texts = index.groupBy("item_id").agg(F.first("raw").alias("item"))
    aligned = (read.join(texts, "item_id").withColumn("ours", F.expr("slice(item, first, last - first + 1)"))
               .withColumn("zipped", F.arrays_zip("ours", template(F.col("ours")).alias("a"), "theirs",
                                                  template(F.col("theirs")).alias("b"))))
    slots = F.expr("transform(filter(zipped, z -> z.a = z.b AND z.a LIKE '<%'), z -> struct(z.a, lower(z.ours) AS o, lower(z.theirs) AS t))")
    return (aligned.filter(F.expr("size(filter(zipped, z -> z.a = z.b))") >= SHORTEST)
            .withColumn("slots", slots)
            .withColumn("consistent", F.expr("size(array_distinct(slots)) = size(array_distinct(transform(slots, s -> struct(s.a, s.o))))"))
            .withColumn("n_changed", F.expr("size(filter(slots, s -> s.o <> s.t))"))
            .select("doc_id", "item_id", "shift", "first", "last", "n_windows", F.size("slots").alias("n_slots"), "n_changed",
                    "consistent"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, n_slots, n_changed: the longest consistent occurrence of an item in a document."""
    best = F.max(F.struct("n_windows", F.expr("-n_changed").alias("c"), "n_slots")).alias("b")
    return (occurrences(docs, items).filter("consistent").groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.n_windows", "b.n_slots", F.expr("-b.c").alias("n_changed")))


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.withColumn("reparameterised", F.col("n_changed") > 0)
