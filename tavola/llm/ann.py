"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Every vector, less the mean of all vectors, is rotated by a fixed random
orthogonal matrix; its code is the signs of the result, one bit a dimension,
packed, with three scalars: the length of the centred vector, the cosine
between its direction and the code's direction, and its product with the mean.
From the packed bits and the scalars the inner product with a query is
estimated without bias, with an error bound of ``eps`` standard deviations.

Vectors are dealt into blocks of bounded size and so are queries; a task holds
one block of each. In a task the best estimates are reranked first, with the
original vectors in double precision; their k-th score is a floor, and only
vectors whose upper bound reaches the floor are reranked as well. The k best of
every block meet per query. Nothing is sampled: the mean is taken over all
rows and every row is coded.

Null or zero vectors, vectors with null or non-finite components and rows
without vec_id take no part. Vectors are compared within one dimension. Rows
that repeat a vec_id: the query's own id is never its neighbour, and a query id
that occurs twice searches once, with its smallest vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tavola.llm.common import map_arrow, park, table

TOP = 20
EVERY = 20
EPS = 1.9
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
SEED = 7
QUERIES_AT_ONCE = 128


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """The fixed random orthogonal matrix of a dimension."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _valid(df: DataFrame) -> DataFrame:
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
            .filter(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite
                    & F.exists(e, lambda x: x != 0)))


def means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean of all vectors, by dimension: one short vector per dimension reaches the driver."""
    rows = (vectors.select(F.size("embedding").alias("dim"), F.posexplode("embedding").alias("i", "x"))
            .groupBy("dim", "i").agg(F.avg("x").alias("m")).orderBy("dim", "i").collect())
    out: dict[int, list[float]] = {}
    for r in rows:
        out.setdefault(r["dim"], []).append(r["m"])
    return {d: np.array(m) for d, m in out.items()}


def encode(vectors: DataFrame, centre: dict[int, np.ndarray], seed: int = SEED) -> DataFrame:
    """vec_id, dim, embedding, norm, cos, code (packed bits): one row per vector."""
    def fn(batch: pa.RecordBatch):
        dim = batch.column("dim").to_numpy()
        for d in np.unique(dim):
            part = batch.filter(pa.array(dim == d))
            x = part.column("embedding").flatten().to_numpy().reshape(-1, d)
            centred = (x - centre[int(d)]) @ rotation(int(d), seed)
            norm = np.sqrt((centred * centred).sum(axis=1))
            cos = np.abs(centred).sum(axis=1) / np.sqrt(d) / np.where(norm > 0, norm, 1)
            code = np.packbits(centred > 0, axis=1)
            yield {"vec_id": part.column("vec_id"), "dim": part.column("dim"), "embedding": part.column("embedding"),
                   "norm": norm, "cos": np.where(norm > 0, cos, 1.0),
                   "code": pa.array([c.tobytes() for c in code], pa.binary())}

    return map_arrow(vectors.withColumn("dim", F.size("embedding")), fn,
                     "vec_id long, dim int, embedding array<double>, norm double, cos double, code binary")


def _search(top: int, eps: float, seed: int, centre: dict[int, np.ndarray]):
    found = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def matrix(t: pa.Table, d: int) -> np.ndarray:
        return t.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, d)

    def fn(key, base: pa.Table, queries: pa.Table) -> pa.Table:
        asked, near, scores = [], [], []
        if base.num_rows and queries.num_rows:
            d = key[1].as_py()
            ids, x, q = base.column("vec_id").to_numpy(), matrix(base, d), matrix(queries, d)
            packed = np.frombuffer(b"".join(base.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            norm, cos = base.column("norm").to_numpy(), base.column("cos").to_numpy()
            signs = np.unpackbits(packed, axis=1)[:, :d].astype(np.float32) * 2 - 1
            signs *= (norm / cos / np.sqrt(d)).astype(np.float32)[:, None]
            spread = (norm * np.sqrt(np.maximum(0, 1 - cos * cos)) / cos / np.sqrt(max(d - 1, 1)) * eps).astype(np.float32)
            turned = (q @ rotation(d, seed)).astype(np.float32)
            shift, length = q @ centre[d], np.sqrt((q * q).sum(axis=1))
            order = np.argsort(ids, kind="stable")
            for s in range(0, len(q), QUERIES_AT_ONCE):
                est = turned[s:s + QUERIES_AT_ONCE] @ signs.T
                for e, i in zip(est, range(s, len(q))):
                    qid = queries.column("vec_id")[i].as_py()
                    own = order[np.searchsorted(ids, qid, "left", order): np.searchsorted(ids, qid, "right", order)]
                    e[own] = -np.inf
                    n = min(top, len(ids) - len(own))
                    if n <= 0:
                        continue
                    best = np.argpartition(e, len(e) - n)[len(e) - n:]
                    floor = (x[best] * q[i]).sum(axis=1).min() - shift[i]
                    pick = np.flatnonzero(e + spread * np.float32(length[i]) >= floor - 1e-5 * (abs(floor) + 1e-9))
                    pick = np.union1d(pick[e[pick] > -np.inf], best)
                    score = (x[pick] * q[i]).sum(axis=1)
                    first = np.lexsort((ids[pick], -score))[:n]
                    asked.append(np.full(n, qid))
                    near.append(ids[pick][first])
                    scores.append(score[first])
        if not asked:
            return found.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in (asked, near, scores)], schema=found)
    return fn


def nearest(vectors: DataFrame, queries: DataFrame, top: int = TOP, eps: float = EPS,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` rows of largest inner product per query row."""
    valid = _valid(vectors)
    centre = means(valid)
    coded = park(encode(valid, centre, seed))
    asked = park(_valid(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
                 .withColumn("dim", F.size("embedding")))
    blocks = max(1, -(-coded.count() // block_rows))
    query_blocks = max(1, -(-asked.count() // query_rows))
    base = (coded.withColumn("block", F.expr(f"pmod(xxhash64(vec_id, 1), {blocks})").cast("int"))
            .withColumn("qblock", F.explode(F.expr(f"sequence(0, {query_blocks - 1})"))))
    asks = (asked.withColumn("qblock", F.expr(f"pmod(xxhash64(vec_id, 2), {query_blocks})").cast("int"))
            .withColumn("block", F.explode(F.expr(f"sequence(0, {blocks - 1})"))))
    keys = ["block", "dim", "qblock"]
    found = base.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(
        _search(top, eps, seed, centre), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def op2_rotated_bits_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))
