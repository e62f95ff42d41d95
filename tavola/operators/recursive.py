"""Recursive explosions (REC-01 .. REC-04) as level-by-level joins.

Bill of materials: the frontier holds one row per (root, recipe) with the
quantity required so far. Each level joins the frontier to the component
edges, divides by the parent's yield, and *aggregates* per (root, component)
before going on - so the work per level is bounded by the number of
distinct (root, node) pairs, never by the number of paths, and a hot recipe
is spread by the shuffle on (root, component). Yields, errors and the kind of every
component are joined to the edges once, so a level is one join and one
grouping; its rows are written to the shared checkpoint directory
(``DataFrame.checkpoint``), which cuts the lineage and lets a lost executor
recompute only one level.

Cycles: a walk on a cyclic graph never empties its frontier, so recipes that
lead into a cycle (``find_cycles``) are taken out first and reported; chains may
be of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.session import ensure_checkpoint_dir


class RecipeError(ValueError):
    pass


def materialise(df: DataFrame, checkpoint: bool) -> DataFrame:
    if not checkpoint:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def explode_bom(edges: DataFrame, yields: DataFrame, roots: DataFrame,
                prep: DataFrame | None = None, on_error: str = "raise",
                checkpoint: bool = True):
    """REC-01/02: explode recipes of recipes into raw ingredients.

    edges   (parent, child, qty, uofm)  quantities already in base units
    yields  (recipe, yield)             base-unit yield; missing -> 1
    roots   (root, recipe)              recipe exploded for each root
    prep    (recipe)                    components that recurse; default:
                                        every recipe that has components

    Returns ``(leaves, errors)``: leaves (root, child, uofm, qty, depth) with
    ``qty`` summed per (root, child, uofm) and ``depth`` the deepest level the
    child was reached at; errors (root, recipe, error) rows (zero or null
    yield, prep recipe without components, recipe on a cycle or leading into
    one). With ``on_error='raise'`` any error raises instead.
    """
    if on_error not in ("raise", "quarantine"):
        raise ValueError("on_error must be 'raise' or 'quarantine'")
    parents = edges.select(F.col("parent").alias("recipe")).distinct()
    prep = (prep.select(F.col(prep.columns[0]).alias("recipe")).distinct()
            if prep is not None else parents)
    missing = prep.join(parents, "recipe", "left_anti")      # prep without components
    prep_children = prep.withColumnRenamed("recipe", "child")
    cyclic = find_cycles(edges.join(prep_children, "child", "left_semi"), checkpoint)
    bad = yields.filter("yield IS NULL OR yield = 0").select("recipe", F.lit("invalid yield").alias("error"))
    errors_of = (cyclic.withColumn("error", F.lit("recipe cycle")).unionByName(bad)
                 .groupBy("recipe").agg(F.max("error").alias("error")))  # of both, the cycle
    # What a level needs to know of a recipe is joined once: per component the
    # factor and whether it goes on, per faulty recipe one row with its error.
    known = (edges.select(F.col("parent").alias("recipe"), "child", "qty", "uofm")
             .join(errors_of, "recipe", "left_anti").join(yields, "recipe", "left")
             .join(prep_children.withColumn("_prep", F.lit(True)), "child", "left")
             .select(F.col("recipe").alias("node"), "child", "uofm", F.coalesce("_prep", F.lit(False)).alias("goes_on"),
                     (F.col("qty") / F.coalesce(F.col("yield"), F.lit(1.0))).alias("factor"), F.lit(None).cast("string").alias("error")))
    faulty = errors_of.select(F.col("recipe").alias("node"), F.col("recipe").alias("child"), F.lit(None).cast("string").alias("uofm"),
                              F.lit(False).alias("goes_on"), F.lit(None).cast("double").alias("factor"), "error")
    known = materialise(known.unionByName(faulty), checkpoint)

    frontier = roots.select("root", F.col("recipe").alias("node"), F.lit(1.0).alias("qty"))
    steps: list[DataFrame] = []
    while True:
        step = (frontier.join(known, "node")
                .groupBy("root", "child", "uofm", "goes_on", "error").agg(F.sum(F.col("qty") * F.col("factor")).alias("qty"))
                .withColumn("depth", F.lit(len(steps) + 1)))
        step = materialise(step, checkpoint)
        steps.append(step)
        down = step.filter("goes_on")
        if down.isEmpty():
            break
        frontier = down.groupBy("root", F.col("child").alias("node")).agg(F.sum("qty").alias("qty"))

    rows = reduce(DataFrame.unionByName, steps)
    leaves = (rows.filter("NOT goes_on AND error IS NULL").groupBy("root", "child", "uofm")
              .agg(F.sum("qty").alias("qty"), F.max("depth").alias("depth")))
    errors = missing.select(F.lit(None).cast(roots.schema["root"].dataType).alias("root"),
                            "recipe", F.lit("prep recipe without components").alias("error"))
    errors = errors.unionByName(rows.filter("error IS NOT NULL").select("root", F.col("child").alias("recipe"), "error"))
    if on_error == "raise":
        first = errors.limit(1).collect()
        if first:
            raise RecipeError(f"{first[0]['error']}: {first[0]['recipe']}")
    return leaves, errors


def find_cycles(edges: DataFrame, checkpoint: bool = True) -> DataFrame:
    """REC-02: recipes that lie on a cycle or lead into one.

    Every round removes the edges into recipes without components and lets
    edges into a recipe with a single component point past it, at that
    component. Both keep the answer: a recipe leads into a cycle if and only if
    one of its components does. The second halves chains, so a chain of n
    recipes is gone after about log2(n) rounds, and edges never get more. It ends
    when every component left has components of its own.
    """
    cur = materialise(edges.select("parent", "child").distinct(), checkpoint)
    while True:
        fan = cur.groupBy(F.col("parent").alias("child")).agg(F.count("*").alias("n"), F.min("child").alias("next"))
        looked = cur.join(fan, "child", "left")
        cur = materialise(looked.select("parent", F.expr("CASE WHEN n = 1 THEN next ELSE child END").alias("child"), "n")
                          .groupBy("parent", "child").agg(F.min(F.coalesce("n", F.lit(0))).alias("n")), checkpoint)
        alive = cur.filter("n > 0").select("parent", "child")
        if cur.filter("n = 0").isEmpty():
            return alive.select(F.col("parent").alias("recipe")).distinct()
        cur = alive


def explode_levels(first: DataFrame, children, emit, more: Column, checkpoint: bool = True) -> DataFrame:
    """REC-03/04: a tree of any depth, level by level.

    ``first`` holds the nodes of level one, already taken apart: the values of a
    node as columns, what hangs below it as a VARIANT column, so that the document
    was parsed once, when it was read. ``emit(level)`` gives the rows of a level
    and ``children(level)`` the nodes of the next one, in the shape of ``first``;
    nodes with children are those where ``more`` holds. Each level is written once
    (``checkpoint``) and read for its rows, its children and the test for the end.
    """
    level = materialise(first, checkpoint)
    out = emit(level)
    while True:
        parents = level.filter(more)
        if parents.isEmpty():
            return out
        level = materialise(children(parents), checkpoint)
        out = out.unionByName(emit(level))
