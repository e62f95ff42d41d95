"""Unit graphs: every unit's factor to its base unit (NUM-07, DOM-20).

A unit of measure is defined as so many of another unit, that one of a third,
and so on to a base unit. ``resolve_units`` closes these definitions by pointer
doubling: each unit knows a unit further on and the factor to it, and every
round replaces that unit by the one it knows itself, so a chain of n units takes
about log2(n) joins. Units that never end at a base are reported with the
reason; where definitions run in a loop, the product of the factors round the
loop says whether they contradict each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.operators.recursive import materialise

# Largest difference of logarithms that counts as the same factor.
SAME_FACTOR = 1e-9


def _jump(left: DataFrame, known: DataFrame, *carry) -> DataFrame:
    """Replace ``at`` by the unit that ``at`` points to; ``carry``: combined columns of both sides."""
    there = known.select(F.col("unit").alias("at"), *[F.col(c).alias(f"_{c}") for c in known.columns if c != "unit"])
    return left.join(there, "at").select("unit", F.col("_at").alias("at"), *carry)


def resolve_units(edges: DataFrame, bases: DataFrame, checkpoint: bool = True) -> DataFrame:
    """unit, base, factor, status, loop_factor for every unit of ``edges`` (unit, other, qty) and ``bases`` (unit).

    One unit is ``qty`` of ``other``; a unit has at most one edge. ``status``:

    * ``ok``: one unit is ``factor`` of ``base`` (a base unit is 1 of itself);
    * ``invalid quantity``: the quantity is null or not above zero;
    * ``no base``: the definitions end elsewhere (no other unit, an unknown one,
      or one with an invalid quantity);
    * ``loop`` / ``contradictory loop``: the unit is defined by itself;
      ``loop_factor`` is the product round the loop, 1 where it is consistent;
    * ``leads into loop``.

    ``base`` and ``factor`` are null but for ``ok``. An edge of a base unit is
    ignored. Empty inputs give an empty result.
    """
    bases = bases.select("unit").distinct()
    own = edges.select("unit", "other", F.col("qty").cast("double").alias("qty")).join(bases, "unit", "left_anti")
    usable = own.filter("other IS NOT NULL AND qty > 0")
    ends = (bases.withColumn("end", F.lit("ok"))
            .unionByName(own.filter("other IS NOT NULL AND NOT coalesce(qty > 0, false)").select("unit", F.lit("invalid quantity").alias("end")))
            .unionByName(own.filter("other IS NULL").select("unit", F.lit("no base").alias("end"))))
    named = own.select("unit").union(bases).distinct()
    unknown = usable.select(F.col("other").alias("unit")).distinct().join(named, "unit", "left_anti")
    done = (ends.unionByName(unknown.withColumn("end", F.lit("unknown")))
            .select("unit", F.col("unit").alias("at"), F.lit(1.0).alias("factor"), F.col("end")))
    done = materialise(done, checkpoint)
    running = materialise(usable.select("unit", F.col("other").alias("at"), F.col("qty").alias("factor"), F.lit(None).cast("string").alias("end")),
                          checkpoint)
    finished, left, steps = [done], running.count(), 1
    # Every round ends the units up to twice as far from an end; a round that ends none leaves only what runs into loops.
    while left:
        known = running.unionByName(done)
        running = materialise(_jump(running, known, (F.col("factor") * F.col("_factor")).alias("factor"), F.col("_end").alias("end")),
                              checkpoint)
        ended = running.filter("end IS NOT NULL")
        finished.append(ended)
        done = done.unionByName(ended)
        running = running.filter("end IS NULL")
        before, left, steps = left, running.count(), steps * 2
        if left == before:
            break
    out = None
    for part in finished:
        part = part.select("unit", F.when(F.col("end") == "ok", F.col("at")).alias("base"),
                           F.when(F.col("end") == "ok", F.col("factor")).alias("factor"),
                           F.when((F.col("end") == "ok") | (F.col("unit") == F.col("at")), F.col("end")).otherwise("no base").alias("status"))
        out = part if out is None else out.unionByName(part)
    out = out.filter("status <> 'unknown'").withColumn("loop_factor", F.lit(None).cast("double"))
    return out.unionByName(_loops(usable, running.select("unit", "at"), left, steps, checkpoint)) if left else out


def _loops(edges: DataFrame, running: DataFrame, n: int, steps: int, checkpoint: bool) -> DataFrame:
    """Units that run into loops: after at least ``n`` steps ``at`` is a unit of the loop, and each of these is reached."""
    while steps < n:
        running = materialise(_jump(running, running), checkpoint)
        steps *= 2
    inside = materialise(running.select(F.col("at").alias("unit")).distinct(), checkpoint)
    size = inside.count()
    # the smallest unit of a loop names it
    ring = edges.join(inside, "unit", "left_semi").select("unit", F.col("other").alias("at"), F.least("unit", "other").alias("loop"),
                                                         F.log("qty").alias("log"))
    names, steps = materialise(ring.select("unit", "at", "loop"), checkpoint), 1
    while steps < size:
        names = materialise(_jump(names, names, F.least("loop", "_loop").alias("loop")), checkpoint)
        steps *= 2
    total = ring.select("unit", "log").join(names.select("unit", "loop"), "unit").groupBy("loop").agg(F.sum("log").alias("log"))
    on = names.join(total, "loop").select(
        "unit", F.when(F.abs("log") <= SAME_FACTOR, "loop").otherwise("contradictory loop").alias("status"), F.exp("log").alias("loop_factor"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("base", "string"), ("factor", "double"))]
    into = running.select("unit").join(inside, "unit", "left_anti").select(
        "unit", *none, F.lit("leads into loop").alias("status"), F.lit(None).cast("double").alias("loop_factor"))
    return on.select("unit", *none, "status", "loop_factor").unionByName(into)
