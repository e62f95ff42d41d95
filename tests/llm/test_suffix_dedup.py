import hashlib
from collections import Counter

import pyarrow.parquet as pq

from tavola.llm.suffix_dedup import op3_suffix_dedup, suffix_dedup
from tests.llm.conftest import EDGE, TINY


def brute(rows, width=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j:j + width] for _, b in raw for j in range(len(b) - width + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if seen[b[j:j + width]] > 1:
                gone[j:j + width] = b"\1" * width
        spans = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_whole_small_table(spark):
    t = pq.read_table(f"{TINY}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    assert Counter(map(tuple, op3_suffix_dedup(spark, TINY).collect())) == brute(rows)


def test_edges_ties_and_repeats(spark, make):
    import random
    rnd = random.Random(5)
    def noise(n):
        return "".join(rnd.choice("abcdefgh é") for _ in range(n))
    shared = noise(450)
    rows = EDGE + [(10, noise(90) + shared[:260] + noise(70)), (11, shared + noise(30)), (11, noise(10) + shared[100:]),
                   (12, "ab" * 300), (13, shared[:199]), (14, noise(300)), (None, shared), (15, shared[50:251] + "é" * 250),
                   (16, shared[250:] + noise(5) + shared[:200])]
    got = suffix_dedup(make(rows), batches=2).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    assert Counter(map(tuple, got.collect())) == brute(rows)
    assert suffix_dedup(make([])).count() == 0
