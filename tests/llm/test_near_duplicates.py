import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from tavola.llm.graph import components, merged
from tavola.llm.order_minhash import (FAR, SHINGLE, WORDS, _scan, _signature, alike, distances, labelled, near_duplicates, op8_order_minhash,
                                      shingles)
from tests.llm.conftest import EDGE, TINY


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


words = st.lists(st.integers(0, 3), max_size=45)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=6), st.sampled_from([0.8, 0.5, 0.0]))
def test_banded_alignment_is_exact(pairs, similarity):
    got = distances([np.array(a, np.int32) for a, _ in pairs], [np.array(b, np.int32) for _, b in pairs], similarity)
    for (a, b), d in zip(pairs, got.tolist()):
        true = edit(a, b)
        assert d == (true if true <= int((1 - similarity) * max(len(a), len(b)) + 1e-9) else FAR)


def test_occurrence_labels():
    g = np.array([5, 7, 5, 5, 7], np.uint64)
    assert len(set(labelled(g).tolist())) == 5 and labelled(g)[0] == 5


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + rnd.randrange(1, 40)) for _ in range(60)] + [(7, 7), (201, 200), (202, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert all(got[i] == 0 for i in range(31)) and got[202] == 200
    assert all(r == 100 for n, r in got.items() if 100 <= n < 200)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_few_links_take_few_tasks(spark):
    """Whatever the number of shuffle partitions, which is that of the large steps."""
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(40)], "u long, v long")
    conf = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    sc = spark.sparkContext
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", "few links")
        got = dict(map(tuple, components(links).collect()))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert set(got.values()) == {0, 100} and len(got) == 81
    tracker = sc.statusTracker()
    infos = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("few links") for s in tracker.getJobInfo(j).stageIds]
    tasks = [i.numTasks for i in infos if i]
    assert tasks and max(tasks) < 100


def test_components_after_further_links(spark):
    rnd = random.Random(6)
    def frame(links):
        return spark.createDataFrame(links, "u long, v long")
    for n in (0, 5, 60):
        old = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(40)]
        new = [(rnd.randrange(100), rnd.randrange(100)) for _ in range(n)]
        got = sorted(map(tuple, merged(components(frame(old)), frame(new)).collect()))
        assert got == sorted(map(tuple, components(frame(old + new)).collect()))
    assert merged(components(frame([])), frame([(3, 2)])).count() == 2


def classes(rows):
    return {r.doc_id: r.class_id for r in rows}


def test_planted_copies(spark, make):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    def noise(n):
        return [rnd.choice(vocabulary) for _ in range(n)]
    rows, truth = [], {}
    hot = noise(60)
    for c in range(25):
        base = noise(rnd.choice([60, 200, 600]))
        for k in range(6):
            b = list(base)
            for _ in range(len(b) // 80):
                b[rnd.randrange(len(b))] = "edit"
            i = rnd.randrange(10**6)
            rows.append((i, "\n".join(b) if k == 5 else " ".join(b)))
            truth[i] = c
    for k in range(60):  # a passage that many different documents share
        i = 2_000_000 + k
        rows.append((i, " ".join(hot + noise(90))))
        truth[i] = ("own", k)
    long = noise(30_000)
    rows += [(3_000_000, " ".join(long)), (3_000_001, " ".join(long[:15_000] + ["x"] * 100 + long[15_000:]))]
    truth |= {3_000_000: "long", 3_000_001: "long"}
    rows += EDGE + [(9, "a b"), (8, "a  b"), (9, "a b")]
    got = near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    by = classes(got)
    assert by[8] == by[9] == 8 and by[1] == 1 and by[2] == 2 and by[None] is None
    groups = {}
    for i, c in truth.items():
        groups.setdefault(c, set()).add(by[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)
    assert near_duplicates(make([])).count() == 0


def test_small_table_against_shingles(spark):
    """Pairs of shingle similarity 0.8 or more over all pairs share a class; linked texts are alike."""
    t = pq.read_table(f"{TINY}/documents.parquet", columns=["doc_id", "text"])
    docs = {i: x.split() for i, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist())}
    by = classes(op8_order_minhash(spark, TINY).collect())
    shingles = {i: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} for i, w in docs.items()}
    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = shingles[i], shingles[j]
            if len(a & b) >= 0.8 * len(a | b):
                assert by[i] == by[j]
            if not a & b:
                assert by[i] != by[j]


def test_scattered_edits_are_judged_by_shingles(make):
    """Both sides of five-word shingle similarity 0.8; the edit similarity is 0.97 or more throughout."""
    base = [f"w{i}" for i in range(400)]
    def edited(n):
        return " ".join("edit" if i % 20 == 10 and i < 20 * n else w for i, w in enumerate(base))
    # n edits leave 396 - 5 n of 396 + 5 n shingles: 0.817 for 8, 0.796 for 9
    rows = [(1, " ".join(base)), (2, edited(8)), (11, " ".join(base[::-1])), (12, " ".join(reversed(edited(9).split())))]
    by = classes(near_duplicates(make(rows), shingle=SHINGLE).collect())
    assert by == {1: 1, 2: 1, 11: 11, 12: 12}
    assert classes(near_duplicates(make(rows)).collect()) == {1: 1, 2: 1, 11: 11, 12: 11}
    short = [np.array(x, np.int32) for x in ([1, 2], [1, 2], [1, 3])]
    assert alike(short[:2], short[1:], 5, SHINGLE).tolist() == [True, False]


def test_query_links_only_by_shingles(spark):
    """Every class of the query is connected by pairs of shingle similarity 0.8."""
    t = pq.read_table(f"{TINY}/documents.parquet", columns=["doc_id", "text"])
    docs = {i: x.split() for i, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist())}
    grams = {i: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} for i, w in docs.items()}
    for i, c in classes(op8_order_minhash(spark, TINY).collect()).items():
        assert i == c or any(len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) for j in docs if j != i)


def test_one_doc_id_with_several_texts(make):
    a, b, c = ("".join(f" {x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (5, c), (9, c), (7, b + " end"), (5, b)]
    got = sorted(tuple(r) for r in near_duplicates(make(rows), shingle=SHINGLE).collect())
    assert got == [(1, 1, 1), (5, 1, 1), (5, 5, 5), (5, 5, 5), (5, 5, 5), (7, 7, 5), (9, 5, 5)]


def test_links_between_texts_that_are_not_the_buckets_first(spark, make):
    """Texts a and b are alike, but share their only bucket with a smaller text that neither is like."""
    rnd = random.Random(3)
    shared = [f"s{i}" for i in range(120)]
    def odd(tag, n):
        return [f"{tag}{i}" for i in range(n)]
    a = shared + odd("x", 60)
    b = list(a)
    b[170] = "other"
    first = shared + odd("y", 60)
    found = 0
    for _ in range(12):  # some of the draws have all three in one bucket
        names = {w: f"{w}q{rnd.randrange(10**6)}" for w in {*a, *b, *first}}
        rows = [(i, " ".join(names[w] for w in t)) for i, t in enumerate((first, a, b))]
        scanned = list(_scan(5, 3, 1)(pa.RecordBatch.from_pydict({"doc_id": [0, 1, 2], "text_id": [0, 1, 2], "text": [t for _, t in rows]})))
        if len({x[0] for x in scanned[0]["bands"].to_pylist()}) > 1:
            continue
        found += 1
        for shingle in (SHINGLE, None):
            got = classes(near_duplicates(make(rows), tables=1, shingle=shingle).collect())
            assert got == {0: 0, 1: 1, 2: 1}
        break
    assert found


def test_parity_bounds_the_different_grams():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 30, 400).astype(np.int32)
    texts = [base, np.r_[base[:200], rng.integers(0, 1 << 30, 80).astype(np.int32), base[200:]], rng.integers(0, 3, 300).astype(np.int32), base[:0]]
    out = next(_signature(5)(pa.RecordBatch.from_pydict({"node": list(range(4)), "codes": [t.tobytes() for t in texts]})))
    sets = [set(shingles(t, 5).tolist()) if len(t) else set() for t in texts]
    assert out["size"].tolist() == [len(s) for s in sets]
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            apart = sum(bin((int(out[f"s{k}"][i]) ^ int(out[f"s{k}"][j])) & (1 << 64) - 1).count("1") for k in range(WORDS))
            assert apart <= len(x ^ y) and (apart > 0 or i == j or not x ^ y)
