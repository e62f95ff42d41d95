import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline as P


def test_pipeline_on_a_small_table(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept, before = {}, docs
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, before, d)
        assert after.columns == docs.columns
        after = P.park(after)
        kept[name] = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
        before = after
    rows = P.run(spark, d).collect()
    assert {r.doc_id for r in rows} == kept["pii"] == kept["decontaminate"] and all(r.round_trip for r in rows)
    texts = dict(zip(*[c.to_pylist() for c in pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"])]))
    labels = pq.read_table(f"{d}/labels.parquet").to_pylist()
    good = [x["doc_id"] for x in labels if x["quality"] == 1 and x["toxic"] == 0]
    assert len(kept["quality"] & set(good)) > 0.95 * len(good)
    junk = [x["doc_id"] for x in labels if x["quality"] == 0]
    assert len(kept["quality"] & set(junk)) < 0.35 * len(junk)
    same = {}
    for i in sorted(kept["quality"]):
        same.setdefault(" ".join(texts[i].split()), []).append(i)
    assert all(not kept["near_duplicates"] & set(ids[1:]) for ids in same.values())
    items = pq.read_table(f"{d}/benchmark.parquet", columns=["text"])["text"].to_pylist()
    assert not [i for i in kept["decontaminate"] if any(x in texts[i] for x in items)]
    gone = kept["near_duplicates"] - kept["decontaminate"]
    assert gone and all(any(" ".join(x.split()[:13]) in " ".join(texts[i].split()) or x[:40] in texts[i] for x in items) for i in gone)
    for r in rows:
        for value in re.findall(r"\b4\d{15}\b|\+1 \(\d{3}\) 555-\d{4}|[\w.]+@mail\d\.example\.com", texts[r.doc_id]):
            assert value not in r.text


def test_stages_with_odd_rows_and_columns(spark, make):
    d = "/root/testdata/sf0.001"
    base = make([(1, None), (2, ""), (None, "a null id"), (5, "some text of few words"), (5, "some text of few words"), (6, "some text of few words"),
                 (7, "x" * 300_000)])
    docs = base.withColumn("lang", F.lit("en")).withColumn("keep", F.lit("mine")).withColumn("class_id", F.lit(3)).withColumn("n_pii", F.lit(1))
    near = P.deduplicate(spark, docs, d)
    assert near.columns == docs.columns
    assert sorted(str(r.doc_id) for r in near.collect()) == ["1", "2", "5", "7", "None"]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns and {r.keep for r in out.collect()} <= {"mine"}
        assert stage(spark, docs.limit(0), d).count() == 0
    assert P.tokens(spark, docs, d).count() == 7


def test_deduplicate_keeps_unique_texts_of_a_repeated_doc_id(spark, make):
    a, b, c = ("".join(f" {x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (9, c), (9, c), (9, c.replace(" ", "  ")), (10, c), (11, b + " end"), (12, None), (12, ""), (12, ""), (None, a)]
    out = P.deduplicate(spark, make(rows), "/root/testdata/sf0.001")
    got = sorted(((r.doc_id, " ".join((r.text or "").split())) for r in out.collect()), key=str)
    assert got == sorted([(1, a.strip()), (5, b.strip()), (9, c.strip()), (12, ""), (12, ""), (None, a.strip())], key=str)
