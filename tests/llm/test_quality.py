import math
import random

import numpy as np
import pyarrow.parquet as pq

from tavola.llm import quality_kn as Q
from tests.llm.conftest import EDGE


def test_model_is_a_distribution_and_matches_direct_formula(spark, make):
    rnd = random.Random(2)
    texts = [(i, "".join(rnd.choice("aab bcé\n") for _ in range(300))) for i in range(5)]
    df = make(texts)
    symbol = Q.alphabet(df)
    logp = Q.dense(Q.estimate(Q.count_grams(df, symbol)))
    p = 10.0 ** logp.astype(float).reshape(-1, Q.ALPHABET)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    # the same estimate from plain dictionaries
    seqs = [[symbol[10]] * 3 + [int(symbol[b]) for b in t.encode()] for _, t in texts]
    counts = {4: {}}
    for s in seqs:
        for i in range(3, len(s)):
            g = tuple(s[i - 3:i + 1])
            counts[4][g] = counts[4].get(g, 0) + 1
    for o in (3, 2, 1):
        counts[o] = {}
        for g in counts[o + 1]:
            counts[o][g[1:]] = counts[o].get(g[1:], 0) + 1
    def prob(g):
        if not g:
            return 1 / Q.ALPHABET
        c = counts[len(g)]
        few = {k: sum(1 for v in c.values() if v == k) for k in (1, 2, 3, 4)}
        y = few[1] / max(few[1] + 2 * few[2], 1)
        d = [0] + [min(max(j - (j + 1) * y * few[j + 1] / max(few[j], 1), .05), j) for j in (1, 2, 3)]
        same = {h: v for h, v in c.items() if h[:-1] == g[:-1]}
        if not same:
            return prob(g[1:])
        total = sum(same.values())
        n = c.get(g, 0)
        return max(n - d[min(n, 3)], 0) / total + sum(d[min(v, 3)] for v in same.values()) / total * prob(g[1:])
    for _ in range(60):
        g = tuple(rnd.randrange(8) for _ in range(4))
        code = sum(int(x) * Q.ALPHABET ** k for k, x in enumerate(reversed(g)))
        assert math.isclose(10 ** float(logp[code]), prob(g), rel_tol=1e-4)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    out = Q.op10_kneser_ney_quality(spark, d).toPandas().set_index("doc_id")
    labels = pq.read_table(f"{d}/labels.parquet").to_pandas().set_index("doc_id")
    assert len(out) == pq.read_table(f"{d}/documents.parquet", columns=["doc_id"]).num_rows
    j = out.join(labels, how="inner")
    good = j[(j.quality == 1) & (j.toxic == 0)].keep.mean()
    bad = j[j.quality == 0].keep.mean()
    assert good > 0.985, good
    assert bad < 0.15, bad


def test_edges(spark, make):
    from pyspark.sql import functions as F
    docs = make(EDGE + [(7, "some plain words here"), (7, "some plain words here")]).withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(7, 1, 0), (None, 1, 0), (4, 0, None)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        got = Q.classify(docs, lab, docs.columns).collect()
        assert len(got) == 8 and all(r.keep == bool(r.text) for r in got)
    assert Q.classify(docs.limit(0), labels, docs.columns).count() == 0


def test_languages_with_few_trusted_rows(spark):
    """0, 1 and 5 trusted rows, in a script of their own: clean texts stay; the sample holds every language."""
    rnd = random.Random(5)
    latin = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 8))) for _ in range(400)]
    greek = ["".join(rnd.choice("\u03b1\u03b2\u03b3\u03b4\u03b5\u03b6\u03b7") for _ in range(rnd.randrange(2, 8))) for _ in range(400)]
    def text(words):
        return " ".join(rnd.choice(words) for _ in range(150))
    rows = [(i, "en", text(latin)) for i in range(600)]
    rows += [(1000 * k + i, f"g{n}", text(greek)) for k, n in ((1, 0), (2, 1), (3, 5)) for i in range(100)]
    rows += [(9000 + i, "en", "".join(chr(rnd.randrange(33, 126)) for _ in range(800))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trusted = list(range(500)) + [2000] + list(range(3000, 3005))
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in Q.classify(docs, labels, ["doc_id", "lang"]).filter("keep").collect()}
    assert all(len([i for i in kept if i // 1000 == k]) >= 98 for k in (1, 2, 3))
    assert len([i for i in kept if i < 600]) >= 585 and not [i for i in kept if i >= 9000]
    sample = Q.trusted_sample(docs, labels, 20, 5).groupBy("lang").pivot("train", [True, False]).count().fillna(0).collect()
    got = {r.lang: (r["true"], r["false"]) for r in sample}
    assert got["g1"] == (0, 1) and got["g5"] == (2, 3) and sum(got["en"]) == 14
    symbol = Q.alphabet(docs.filter("lang <> 'g0' AND doc_id < 3005"))
    assert len({int(symbol[b]) for b in "\u03b1\u03b2\u03b3".encode()}) == 4


def test_every_trusted_document_is_used(spark):
    """More trusted documents than any sample held: all are counted or set the limits, half and half in each language."""
    ids = spark.range(30_000)
    docs = ids.selectExpr("id AS doc_id", "CASE id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' END AS lang", "concat('text ', id) AS text")
    labels = ids.selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    got = Q.trusted_sample(docs, labels).groupBy("lang", "train").count().collect()
    assert {(r.lang, r.train): r["count"] for r in got} == {(k, t): 5000 for k in ("en", "fr", None) for t in (True, False)}
    nth = Q.trusted_ids(docs, labels).filter("l = 'en'").orderBy("h").select("nth").collect()
    assert [r.nth for r in nth] == list(range(1, 10_001))


def test_every_byte_is_told_apart(spark):
    """Words of the rarest bytes and the same bytes in another order: no two bytes share a symbol."""
    rnd = random.Random(9)
    common = [chr(c) for c in range(33, 91)]
    rare = ["\u0436\u0438\u0437\u043d\u044c", "\u043c\u0438\u0440"]
    rows = [(i, "x", " ".join("".join(rnd.choices(common, k=5)) for _ in range(60)) + " " + rare[i % 2]) for i in range(200)]
    rows += [(900, "x", " ".join(rare * 20)), (901, "x", " ".join(w[::-1] for w in rare * 20))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    assert len(set(Q.alphabet(docs, Q.BYTES).tolist())) == 256
    got = {r.doc_id: r.perplexity for r in Q.classify(docs, labels, ["doc_id", "lang"]).filter("doc_id >= 900").collect()}
    assert got[901] > 2 * got[900], got


def test_lookup_is_the_table(spark, make):
    rnd = random.Random(3)
    df = make([(i, "".join(rnd.choice("aab bc\u00e9\n") for _ in range(300))) for i in range(5)])
    model = Q.estimate(Q.count_grams(df, Q.alphabet(df)))
    code = np.arange(0, Q.ALPHABET ** 4, 7, dtype=np.uint32)
    code = np.concatenate([code, model["gram"][(model["order"] == 4) & model["seen"]]])
    assert np.allclose(Q.Lookup(model, Q.ALPHABET)(code), Q.dense(model)[code], atol=1e-5)
