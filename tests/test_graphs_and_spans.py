"""Cycles, unit graphs, cost spans and known prefixes against plain Python."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tavola.operators import recursive
from tavola.operators.recursive import explode_bom, find_cycles
from tavola.operators.unitgraph import resolve_units
from tavola.plans import cost
from tavola.plans.records import strip_known_prefix
from tavola.sources.mart import Mart

SF = "/root/testdata/sf0.001"


def into_cycles(edges):
    alive = set(edges)
    while True:
        heads = {p for p, _ in alive}
        left = {e for e in alive if e[1] in heads}
        if left == alive:
            return heads
        alive = left


def rounds_of(monkeypatch, run):
    n = []
    real = recursive.materialise
    monkeypatch.setattr(recursive, "materialise", lambda df, checkpoint: n.append(1) or real(df, checkpoint))
    return run(), len(n)


def test_chain_of_a_thousand_recipes_takes_few_rounds(spark, monkeypatch):
    chain = [(f"r{i}", f"r{i + 1}") for i in range(1000)]
    df = spark.createDataFrame(chain, "parent string, child string")
    found, rounds = rounds_of(monkeypatch, lambda: find_cycles(df).count())
    assert found == 0 and rounds <= 13
    ring = spark.createDataFrame(chain + [("r1000", "r400")], "parent string, child string")
    found, rounds = rounds_of(monkeypatch, lambda: {r.recipe for r in find_cycles(ring).collect()})
    assert found == {f"r{i}" for i in range(1001)} and rounds <= 13


def test_cycles_of_random_graphs(spark):
    rnd = random.Random(6)
    edges = []
    for g in range(60):  # graphs side by side, told apart by their names
        n = rnd.randint(1, 9)
        edges += {(f"{g}.{rnd.randrange(n)}", f"{g}.{rnd.randrange(n)}") for _ in range(rnd.randint(1, 12))}
    df = spark.createDataFrame(edges + edges[:20], "parent string, child string")
    assert {r.recipe for r in find_cycles(df).collect()} == into_cycles(edges)


def test_explosion_quarantines_what_leads_into_cycles(spark):
    edges = [("M", "P", 2.0), ("P", "A", 1.0), ("A", "B", 1.0), ("B", "A", 1.0), ("M", "x", 3.0), ("N", "y", 1.0), ("N", "Z", 1.0), ("Z", "w", 1.0)]
    e = spark.createDataFrame([(*x, "Each") for x in edges], "parent string, child string, qty double, uofm string")
    y = spark.createDataFrame([("Z", None), ("N", 2.0)], "recipe string, yield double")
    roots = spark.createDataFrame([("M", "M"), ("N", "N")], "root string, recipe string")
    leaves, errors = explode_bom(e, y, roots, on_error="quarantine")
    assert sorted((r.root, r.child, r.qty) for r in leaves.collect()) == [("N", "y", 0.5)]
    assert sorted((r.root, r.recipe, r.error) for r in errors.collect()) == [("M", "M", "recipe cycle"), ("N", "Z", "invalid yield")]


def walk(units, bases):
    """Definition of resolve_units, one unit after the other."""
    out = {b: ("ok", b, 1.0, None) for b in bases}
    for u, (other, q) in units.items():
        if u in bases:
            continue
        path, at, factor = [u], u, 1.0
        while True:
            if at in bases:
                out[u] = ("ok", at, factor, None)
                break
            if at not in units or units[at][0] is None:
                out[u] = ("no base", None, None, None)
                break
            nxt, qty = units[at]
            if not (qty or 0) > 0:
                out[u] = ("invalid quantity" if at == u else "no base", None, None, None)
                break
            factor *= qty
            if nxt in path:
                if nxt == u:
                    out[u] = ("loop" if abs(math.log(factor)) < 1e-9 else "contradictory loop", None, None, factor)
                else:
                    out[u] = ("leads into loop", None, None, None)
                break
            path.append(nxt)
            at = nxt
    return out


def resolved(spark, units, bases):
    e = spark.createDataFrame([(u, o, q) for u, (o, q) in units.items()], "unit string, other string, qty double")
    b = spark.createDataFrame([(x,) for x in bases], "unit string")
    return {r.unit: (r.status, r.base, r.factor, r.loop_factor) for r in resolve_units(e, b).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for u, (status, base, factor, loop) in want.items():
        assert got[u][:2] == (status, base), u
        for x, y in ((got[u][2], factor), (got[u][3], loop)):
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9)), u


def test_units_of_random_graphs(spark):
    rnd = random.Random(8)
    units, bases = {}, []
    for g in range(40):
        n = rnd.randint(1, 12)
        bases += [f"{g}.0"] if rnd.random() < 0.7 else []
        for i in range(n):
            other = rnd.choice([None, f"{g}.unheard"]) if rnd.random() < 0.1 else f"{g}.{rnd.randrange(n)}"
            units[f"{g}.{i}"] = (other, rnd.choice([0.5, 2.0, 2.0, 4.0, 0.25, 3.0, 0.0, None]) if rnd.random() < 0.5 else 2.0)
    same(resolved(spark, units, bases), walk(units, bases))
    assert resolved(spark, {}, []) == {} and resolved(spark, {}, ["Each"]) == {"Each": ("ok", "Each", 1.0, None)}


def test_long_chain_of_units(spark, monkeypatch):
    units = {f"u{i}": (f"u{i - 1}", 2.0 if i % 2 else 0.5) for i in range(1, 700)}
    got, rounds = rounds_of_units(spark, units, monkeypatch)
    same(got, walk(units, ["u0"]))
    assert rounds <= 14


def rounds_of_units(spark, units, monkeypatch):
    from tavola.operators import unitgraph
    n = []
    real = unitgraph.materialise
    monkeypatch.setattr(unitgraph, "materialise", lambda df, checkpoint: n.append(1) or real(df, checkpoint))
    return resolved(spark, units, ["u0"]), len(n)





def costs_by_week(purchases, counts, last):
    """DOM-06 for every week by looking at all rows (key, week, order, cost)."""
    out = {}
    for w in range(last + 1):
        for k in {p[0] for p in purchases} | {c[0] for c in counts}:
            p = max((p for p in purchases if p[0] == k and p[1] <= w), key=lambda p: (p[1], p[2]), default=None)
            c = min((c for c in counts if c[0] == k), key=lambda c: (c[1], c[2]), default=None)
            c = c if c and c[1] <= w else None
            best = c if p is None or (c and p[3] == 0.0) else p
            if best:
                out[k, w] = (best[2], best[3])
    return out


def facts(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(k, 1, w, dt.date(2024, 1, 1) + dt.timedelta(days=7 * w + n), n, n, float(c), 1.0, f"i{n}", "Each", c)
                                  for k, w, n, c in rows],
                                 "id long, itemid long, week_index int, date date, transactionid long, lineid long, amount double, "
                                 "quantity double, item string, base_uofm string, base_cost double")


def made(seed, keys=25):
    rnd = random.Random(seed)
    return [(rnd.randrange(keys), rnd.randrange(7), n % 7, rnd.choice([0.0, 1.0, 2.0])) for n in range(70)]


def unique(rows):
    return list({(k, w, n): (k, w, n, c) for k, w, n, c in rows}.values())


def by_week(df):
    out = {}
    for r in df.collect():
        for w in range(r.from_week, r.to_week + 1):
            assert (r.store_id, w) not in out
            out[r.store_id, w] = (int(r.item[1:]), r.base_cost)
    return out


def test_spans_and_increments_against_every_week(spark):
    bought, counted = unique(made(1)), unique(made(2))
    p, c = facts(spark, bought), facts(spark, counted)
    full = cost.cost_spans(p, c, 9)
    assert by_week(full) == costs_by_week(bought, counted, 9)
    runs = sorted((r.store_id, r.from_week, r.to_week, r.date, r.base_cost) for r in full.collect())
    assert not any(a[0] == b[0] and a[2] + 1 == b[1] and a[3:] == b[3:] for a, b in zip(runs, runs[1:]))
    old = [r for r in bought if r[0] % 3 or r[1] < 4]
    batch = [r for r in bought if r not in old]
    before = cost.cost_spans(facts(spark, old), c, 6)
    touched = facts(spark, batch).selectExpr("id AS store_id", "itemid AS item_id")
    after = cost.refresh_spans(before, touched, p, c, 6, 9)
    assert sorted(map(str, after.collect())) == sorted(map(str, full.select(*after.columns).collect()))


def test_increment_of_the_mart_and_weekly_rows(spark):
    m = Mart(spark, SF)
    full = cost.weekly_cost_spans(m)
    inc = cost.weekly_cost_increment(m).select(*full.columns)
    assert full.exceptAll(inc).isEmpty() and inc.exceptAll(full).isEmpty()
    weeks = cost.expand_weeks(full)
    rows = cost.weekly_base_cost_all(m).select(*weeks.columns)
    assert weeks.exceptAll(rows).isEmpty() and rows.exceptAll(weeks).isEmpty()


def longest(name, known):
    hits = [p for p in known if p and name is not None and name.startswith(p + " ")]
    return name[len(max(hits, key=len)) + 1:] if hits else name


words = st.lists(st.sampled_from(["a", "b", "", "ä"]), min_size=1, max_size=5).map(" ".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(words, max_size=25), st.lists(words, max_size=10))
def test_longest_known_prefix(spark, names, known):
    df = spark.createDataFrame([(x,) for x in names + [None]], "n string")
    k = spark.createDataFrame([(x,) for x in known + [None]], "p string")
    got = sorted(((r.n, r.rest) for r in strip_known_prefix(df, "n", k, "rest").collect()), key=str)
    assert got == sorted(((x, longest(x, known)) for x in names + [None]), key=str)


def test_prefixes_when_all_names_share_the_first_word(spark):
    df = spark.range(3000).selectExpr("concat('Casual item ', id % 700, ' size ', id) AS n")
    known = spark.range(700).selectExpr("concat('Casual item ', id) AS p")
    out = strip_known_prefix(df, "n", known, "rest")
    assert out.filter("rest NOT LIKE 'size %'").count() == 0
    joins = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_hash" in joins
