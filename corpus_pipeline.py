"""From raw documents to token ids: filter, deduplicate, decontaminate, pseudonymise, encode.

Each stage takes the documents its predecessor kept and returns documents with
the same columns; the last one returns their ids and the text decoded from
them. ``run`` writes every stage's result as a table below the shared
checkpoint folder and reads it again, so a lost executor costs tasks of one
stage only. Stages judge whole texts and drop nothing but what they are for:

* quality: documents that the Kneser-Ney classifier rejects, and empty ones;
* near_duplicates: all rows of a class but one, that of its first text under the
  smallest doc_id; rows without doc_id stay, and so do rows that share a doc_id
  while their texts are of different classes;
* decontaminate: documents that hold a benchmark item;
* pii and tokens: nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm.common import park, table
from tavola.llm.decontaminate import contaminated
from tavola.llm.order_minhash import SHINGLE, rows_with_classes
from tavola.llm.pii import TEST_KEY, key_of, pseudonymise
from tavola.llm.quality_kn import classify
from tavola.llm.sentencepiece_viterbi import encode


def _plain(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with columns other than ``used`` under names that no operator uses."""
    return docs.toDF(*[c if c in used else f"column_{i}" for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    plain = _plain(docs, "doc_id", "lang", "text")
    kept = classify(plain, labels, plain.columns).filter("keep")
    return kept.select(*plain.columns).toDF(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_id = F.xxhash64(F.col("text").cast("string"))
    groups = park(rows_with_classes(docs, shingle=SHINGLE).filter("doc_id IS NOT NULL")
                  .groupBy("doc_id", "class_id", "node", "leads", "text_id").agg(F.count("*").alias("n")))
    # of a class stays the row of its first text under its smallest doc_id; of several spellings of it the first
    lead = F.expr("leads AND doc_id = class_id")
    spelt = groups.filter(lead & F.col("node").isNotNull()).groupBy("doc_id", "node").agg(F.min("text_id").alias("first"), F.count("*").alias("k"))
    gone = groups.filter(~lead).select("doc_id", "text_id").unionByName(
        groups.filter(lead).join(spelt.filter("k > 1"), ["doc_id", "node"]).filter("text_id <> first").select("doc_id", "text_id"))
    gone = park(gone.withColumnRenamed("doc_id", "gone_id").withColumnRenamed("text_id", "gone_text"))
    repeated = park(groups.filter("n > 1").select(F.col("doc_id").alias("again_id"), F.col("text_id").alias("again_text")))
    plain = _plain(docs, "doc_id", "text").withColumn("text_id", text_id)
    left = plain.join(gone.hint("shuffle_hash"), F.expr("doc_id = gone_id AND text_id = gone_text"), "left_anti")
    same = F.expr("doc_id = again_id AND text_id = again_text")
    if repeated.count() < 100_000:
        repeated = F.broadcast(repeated)
    twice = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text_id"])
    out = left.join(repeated, same, "left_anti").unionByName(twice)
    return out.drop("text_id").toDF(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).select("doc_id").distinct()
    return docs.join(park(found).hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain = _plain(docs, "doc_id", "text")
    others = tuple(c for c in plain.columns if c != "text")
    out = pseudonymise(plain, key_of(spark, TEST_KEY), others).select(*plain.columns).toDF(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, decoded=True)


STAGES = [("quality", quality), ("near_duplicates", deduplicate), ("decontaminate", decontaminate), ("pii", pii), ("tokens", tokens)]

# The classifier, the banded alignment and the Viterbi search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, round_trip, text of every document that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = park(stage(spark, docs, sf_dir), tidy=True)
    return STAGES[-1][1](spark, docs, sf_dir)
