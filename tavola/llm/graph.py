"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.llm.common import discard, few, park


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of ``links`` (u, v long).

    Each round rewrites the links so that neighbours point at smaller nodes; it
    ends when nothing changes, after O(log n) rounds. A node with very many
    links is a pre-aggregated minimum and a join that can be split, never a
    gathered list. Only two numbers per round reach the driver. The steps of a
    round take as many tasks as the links need, whatever the shuffle partitions.
    """
    links = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = park(few(links.distinct(), links.count()))
    state = _state(edges)
    while state[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rows = 2 * state[0]
        small = park(few(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), rows))
        large_star = park(few(both.join(small, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                              .distinct(), rows))
        low = park(few(large_star.groupBy("u").agg(F.min("v").alias("m")), rows))
        hung = large_star.join(low, "u")
        after = park(few(hung.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), rows))
        now = _state(after)
        for old in (edges, small, large_star, low):
            discard(old)
        edges, before, state = after, state, now
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        few(edges.select("v").distinct(), state[0]).select(F.col("v").alias("node"), F.col("v").alias("root")))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots``, as of ``components``, after further links: only these are followed, between the components that stand."""
    ends = (links.join(roots.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left")
            .join(roots.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left")
            .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    over = park(components(park(ends)))
    stood = roots.join(over.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return stood.select("node", F.coalesce("top", "root").alias("root")).unionByName(over.join(roots, "node", "left_anti").select("node", "root"))
