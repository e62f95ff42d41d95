import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tavola.llm.ann import nearest, op2_rotated_bits_ann, rotation


def exact(ids, x, queries, top):
    out = {}
    for i in queries:
        s = (x * x[ids == i][0]).sum(axis=1)
        keep = ids != i
        order = np.lexsort((ids[keep], -s[keep]))[:top]
        out[int(i)] = list(zip(ids[keep][order].tolist(), s[keep][order].tolist()))
    return out


def test_recall_and_scores_on_a_large_table(spark, tmp_path):
    """20,000 clustered vectors in several blocks on both sides: recall is at least 0.9, scores are exact."""
    rnd = np.random.default_rng(11)
    middles = rnd.normal(size=(200, 64))
    x = (middles[rnd.integers(0, 200, 20_000)] + 0.7 * rnd.normal(size=(20_000, 64))).astype(np.float32)
    ids = rnd.permutation(20_000)
    vectors = pa.table({"vec_id": pa.array(ids), "embedding": pa.array(list(x), pa.list_(pa.float32()))})
    pq.write_table(vectors, tmp_path / "embeddings.parquet")
    x = x.astype(np.float64)
    want = exact(ids, x, ids[ids % 20 == 0], 20)
    df = spark.read.parquet(str(tmp_path / "embeddings.parquet"))
    got = {}
    for r in nearest(df, df.filter("vec_id % 20 = 0"), block_rows=6_000, query_rows=400).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    full = {int(i): v for i, v in zip(ids, x)}
    for q, rows in got.items():
        assert [r for r, _, _ in sorted(rows)] == list(range(1, 21))
        assert all(s == pytest.approx(float((full[q] * full[v]).sum()), rel=1e-12) for _, v, s in rows)


def test_query_on_a_given_table(spark):
    d = "/root/testdata/sf0.1"
    t = pq.read_table(f"{d}/embeddings.parquet")
    ids, x = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), dtype=np.float64)
    want = exact(ids, x, ids[ids % 20 == 0], 20)
    got = {}
    for r in op2_rotated_bits_ann(spark, d).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {v for v, _ in want[q]}) for q in want) >= 0.99 * sum(map(len, want.values()))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (21, [0.5, 0.5]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, []), (40, [1.0, 2.0, 3.0]), (60, None), (80, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, code string")
    got = {}
    for r in nearest(df, df.filter("vec_id % 20 = 0"), top=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == {
        0: [(1, 3, 0.5), (2, 20, 0.5), (3, 21, 0.5)], 20: [(1, 0, 0.5), (2, 3, 0.5), (3, 21, 0.5)],
        80: [(1, 3, -0.5), (2, 20, -0.5), (3, 21, -0.5)]}
    assert nearest(df.limit(0), df.limit(0)).count() == 0


def test_rotation_is_orthogonal():
    q = rotation(64)
    assert np.allclose(q @ q.T, np.eye(64))
