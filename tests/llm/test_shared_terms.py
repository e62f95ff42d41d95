import math
import re
from collections import Counter

import duckdb
import numpy as np

from tavola.llm.catalog import ORACLE
from tavola.llm.shared_terms import item_terms, op11_shared_term_search, ranked, sharing_plan
from tests.llm.conftest import EDGE, TINY

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, top):
    """Plain definition: one score after the other."""
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, Counter(b), len(b)) for i, b in bags if b]
    n, length = len(bags), sum(k for _, _, k in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in wanted.items():
        scored = []
        for d, b, k in bags:
            m = 50 + 50 * k * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                    for t in ts if t in b)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def found(df):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def random_texts(seed, n, size, words=60):
    rnd = np.random.default_rng(seed)
    p = 1 / np.arange(1, words + 1)
    return [" ".join(f"W{k}" for k in rnd.choice(words, rnd.integers(0, size), p=p / p.sum())) for _ in range(n)]


def test_against_definition(spark, make):
    docs = [(i % 150, t) for i, t in enumerate(random_texts(1, 170, 40))] + [(200 + i, "w1 W2, w3!") for i in range(30)]
    items = list(enumerate(random_texts(2, 25, 20))) + [(3, "w59 w58"), (None, "w1"), (90, None), (91, "unheard"), (92, "W1 w1 w1")]
    df = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, term int")
    for top, block in ((7, 1_000_000), (50, 40), (1, 1)):
        assert found(ranked(make(docs), df, top, block)) == by_hand(docs, items, top)


def test_plan_shares_term_sets(spark):
    items = list(enumerate(random_texts(5, 300, 25)))
    df = spark.createDataFrame(items, "item_id long, text string")
    plan = sharing_plan(item_terms(df)).collect()
    nodes = {r.node: r for r in plan if r.item_id is None}

    def words(k):
        r = nodes[k]
        return set(r.terms) if r.level == 0 else words(r.left) | words(r.right)
    roots = {r.item_id: words(r.node) for r in plan if r.item_id is not None}
    assert roots == {i: set(terms(t)) for i, t in items if terms(t)}
    assert all(nodes[r.left].level < r.level and nodes[r.right].level < r.level for r in nodes.values() if r.level)
    inner = [r for r in nodes.values() if r.level]
    assert len({(r.left, r.right) for r in inner}) == len(inner)
    assert len(inner) < 0.6 * sum(len(w) - 1 for w in roots.values())  # additions a document


def test_edges(spark, make):
    odd = "Ünï\x00cödé \x7f日本語,ABC-abc İK"
    docs = EDGE + [(7, odd), (7, odd), (8, "x " * 300_000 + "日本語"), (9, "abc"), (10, "ABC")]
    items = [(1, "日本語 abc"), (2, "İK Ünï"), (3, ""), (4, " -- ")]
    df = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked(make(docs), df)) == by_hand(docs, items, 50)
    assert ranked(make([]), df).count() == 0 and ranked(make(docs), df.limit(0)).count() == 0
    assert ranked(make([(1, None)]), df).count() == 0


def test_query_equals_its_sql(spark):
    with duckdb.connect() as c:
        for t in ("documents", "benchmark"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TINY}/{t}.parquet'")
        want = sorted(c.execute(ORACLE["op11_shared_term_search"]).fetchall())
    assert found(op11_shared_term_search(spark, TINY)) == want and len(want) > 1000
