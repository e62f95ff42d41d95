import pytest
from pyspark.sql import functions as F

from tavola.operators import merge
from tavola.operators.aggregates import pivot_margins, with_totals
from tavola.operators.joins import latest_as_of_all, merge_with_fallback, validate_fk
from tavola.operators.quality import DataQualityError, require_unique
from tavola.operators.recursive import RecipeError, explode_bom, find_cycles
from tavola.operators.windows import dedup, top_per_group, vs_group_mean


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_top_per_group_tiebreak(spark):
    df = spark.createDataFrame([(1, "2024-01-02", 5, "a"), (1, "2024-01-02", 7, "b"), (1, "2024-01-01", 9, "c")],
                               "k int, d string, t int, v string")
    assert rows(top_per_group(df, ["k"], ["d", "t"], descending=True), "v") == [("b",)]
    assert rows(top_per_group(df, ["k"], ["d", "t"], descending=False), "v") == [("c",)]


def test_dedup_keep_first_last(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "k int, o int, v string")
    assert rows(dedup(df, ["k"], ["o"], "last"), "k", "v") == [(1, "y"), (2, "z")]
    assert rows(dedup(df, ["k"], ["o"], "first"), "k", "v") == [(1, "x"), (2, "z")]


def test_vs_group_mean_pandas_semantics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None)], "g string, m double")
    out = vs_group_mean(df, ["g"], {"hi": "m"})
    assert rows(out, "m", "hi") == sorted([(1.0, False), (3.0, True), (None, True)], key=str)


def test_with_totals_and_margins(spark):
    df = spark.createDataFrame([("s", 2.0, 10.0, 4.0), ("s", 1.0, 0.0, None)],
                               "g string, qty double, sales double, cost double")
    t = with_totals(df, ["g"], ["qty", "sales", "cost"], {"pct": ("cost", "sales", 1.0)})
    tot = [r for r in t.collect() if r.row_type == "Total"][0]
    assert (tot.qty, tot.sales, tot.cost, tot.pct) == (3.0, 10.0, 4.0, 0.4)
    m = pivot_margins(df, "g", "qty")
    assert rows(m, "g", "qty") == [("Total", 3.0), ("s", 3.0)]


def _feed(spark, data):
    return spark.createDataFrame(data, "id int, loc string, d string, version string, amount double")


def test_superseded_any_vs_absent(spark):
    target = _feed(spark, [(1, "L", "d1", "v1", 1.0), (2, "L", "d1", None, 2.0), (3, "L", "d2", "v1", 3.0),
                           (4, "M", "d1", "v1", 4.0)])
    batch = _feed(spark, [(10, "L", "d1", "v1", 1.0), (11, "L", "d1", "v2", 1.0), (12, "L", "d2", "v2", 1.0)])
    anyv = merge.drop_superseded_any(target, batch, ["loc", "d"], "version")
    absent = merge.drop_superseded_absent(target, batch, ["loc", "d"], "version")
    # "different": a v2 row on (L, d1) removes id 1 although v1 is still sent; the null version stays
    assert rows(anyv, "id") == [(2,), (4,)]
    # "absent": id 1 stays (v1 still sent), the null version goes, id 3 goes (only v2 sent)
    assert rows(absent, "id") == [(1,), (4,)]


def test_upsert_idempotent_and_sync(spark):
    target = _feed(spark, [(1, "L", "d1", "v1", 1.0), (2, "L", "d1", "v1", 2.0)])
    batch = _feed(spark, [(2, "L", "d1", "v2", 20.0), (3, "L", "d2", "v2", 30.0)])
    once = merge.upsert(target, batch, ["id"])
    twice = merge.upsert(once, batch, ["id"])
    assert rows(once, "id", "amount") == rows(twice, "id", "amount") == [(1, 1.0), (2, 20.0), (3, 30.0)]
    assert rows(merge.sync(once, batch, ["id"]), "id", "amount") == [(2, 20.0), (3, 30.0)]
    sub = merge.upsert(target, batch, ["id"], update_cols=["amount"])
    assert rows(sub, "id", "version", "amount") == [(1, "v1", 1.0), (2, "v1", 20.0), (3, "v2", 30.0)]


def test_duplicate_batch_and_empty_range_guard(spark):
    batch = _feed(spark, [(1, "L", "d1", "v1", 1.0), (1, "L", "d1", "v2", 2.0)])
    with pytest.raises(DataQualityError):
        require_unique(batch, ["id"])
    last = merge.prepare_batch(batch, ["id"], "last", ["version"])
    assert rows(last, "version") == [("v2",)]
    with pytest.raises(DataQualityError):
        merge.replace_range(batch, batch.limit(0), "d", "d0", "d9")


def test_validate_fk(spark):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert rows(validate_fk(df, "fk", parent, "pk"), "id", "fk") == \
        sorted([(1, 10), (2, None), (3, None)], key=str)


def test_latest_as_of_all_matches_brute_force(spark):
    data = [(1, 0, 5.0), (1, 2, 6.0), (1, 2, 7.0), (2, 3, 1.0)]   # key, week, value
    df = spark.createDataFrame(data, "k int, w int, v double")
    got = rows(latest_as_of_all(df, ["k"], "w", ["w", "v"], 1, 4), "k", "w", "v")
    want = []
    for k in (1, 2):
        for w in range(1, 5):
            prior = [r for r in data if r[0] == k and r[1] <= w]
            if prior:
                want.append((k, w, max(prior, key=lambda r: (r[1], r[2]))[2]))
    assert got == sorted(want, key=str)


def test_merge_with_fallback(spark):
    p = spark.createDataFrame([(1, 0.0), (2, 5.0)], "k int, c double")
    f = spark.createDataFrame([(1, 3.0), (3, 4.0)], "k int, c double")
    out = merge_with_fallback(p, f, ["k"], ["c"], F.col("p_c") == 0)
    assert rows(out, "k", "c", "source") == [(1, 3.0, "fallback"), (2, 5.0, "primary"), (3, 4.0, "fallback")]


def _bom(spark, edges, yields):
    e = spark.createDataFrame(edges, "parent string, child string, qty double, uofm string")
    y = spark.createDataFrame(yields, "recipe string, yield double")
    return e, y


def test_explode_bom_path_products(spark):
    e, y = _bom(spark, [("M", "P", 2.0, "Each"), ("M", "x", 1.0, "Each"), ("P", "x", 3.0, "Each"),
                        ("P", "Q", 1.0, "Each"), ("Q", "z", 4.0, "OZ-wt")], [("P", 2.0)])
    roots = spark.createDataFrame([("M", "M")], "root string, recipe string")
    leaves, errors = explode_bom(e, y, roots)
    # x: 1 + 2*3/2 = 4 ; z: 2 * 1/2 * 4 = 4 (Q has no yield -> 1)
    assert rows(leaves, "child", "qty") == [("x", 4.0), ("z", 4.0)]
    assert errors.count() == 0


def test_explode_bom_errors(spark):
    e, y = _bom(spark, [("M", "P", 1.0, "Each"), ("P", "x", 1.0, "Each")], [("P", 0.0)])
    roots = spark.createDataFrame([("M", "M")], "root string, recipe string")
    with pytest.raises(RecipeError):
        explode_bom(e, y, roots)
    ce, cy = _bom(spark, [("A", "B", 1.0, "Each"), ("B", "A", 1.0, "Each"), ("B", "c", 1.0, "Each")], [])
    croots = spark.createDataFrame([("A", "A")], "root string, recipe string")
    leaves, errs = explode_bom(ce, cy, croots, on_error="quarantine")
    assert [r.error for r in errs.collect()] == ["recipe cycle"] and leaves.count() == 0
    assert rows(find_cycles(ce), "recipe") == [("A",), ("B",)]
    prep = spark.createDataFrame([("P",), ("Z",)], "recipe string")
    _, errs2 = explode_bom(e, spark.createDataFrame([], "recipe string, yield double"), roots,
                           prep=prep, on_error="quarantine")
    assert ("Z", "prep recipe without components") in rows(errs2, "recipe", "error")


def test_long_recipe_chain(spark):
    e, y = _bom(spark, [(f"r{i}", f"r{i + 1}", 2.0, "Each") for i in range(70)], [])
    roots = spark.createDataFrame([("M", "r0")], "root string, recipe string")
    leaves, errors = explode_bom(e, y, roots)
    assert rows(leaves, "child", "qty", "depth") == [("r70", 2.0 ** 70, 70)] and errors.count() == 0
    assert find_cycles(e).count() == 0


def test_fiscal_columns_have_no_bounds(spark):
    import datetime as dt
    from tavola.operators.calendar import fiscal_columns, fiscal_week_index
    days = spark.createDataFrame([(dt.date(1994, 12, 31),), (dt.date(1995, 1, 1),), (dt.date(2025, 1, 2),)], "d date")
    got = {r["date"].isoformat(): (r.year, r.period, r.week, r.dow, r.week_index) for r in
           days.select(*fiscal_columns("d", "1995-01-01")).collect()}
    assert got["1994-12-31"] == (1994, 13, 4, 7, -1) and got["1995-01-01"] == (1995, 1, 1, 1, 0)
    y, p, w, _, index = got["2025-01-02"]
    assert fiscal_week_index("1995-01-01", y, p, w) == index == 10959 // 7


def test_duplicate_batches_and_mappings_fail(spark):
    from tavola.operators import merge
    from tavola.operators.quality import DataQualityError
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    for cols in (None, ["v"]):
        with pytest.raises(DataQualityError):
            merge.upsert(t, twice, ["k"], update_cols=cols)
        assert rows(merge.upsert(t, twice, ["k"], update_cols=cols, on_duplicate="last", order=["v"]), "k", "v") == \
            [(1, "y"), (2, "b")]
    with pytest.raises(DataQualityError):
        merge.apply_renames(t, spark.createDataFrame([("a", "x"), ("a", "y")], "old string, new string"), "v")
    with pytest.raises(DataQualityError):
        merge.replace_range(t, spark.createDataFrame([(7, "z")], "k int, v string"), "k", 1, 3)


def test_version_survives_a_dead_attempt(spark, tmp, monkeypatch):
    from tavola.operators import merge
    base = f"{tmp}/t"
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    merge.safe_upsert(base, one, ["k"])
    point = merge._point_at
    def die(*_):
        raise OSError("killed between write and pointer")
    monkeypatch.setattr(merge, "_point_at", die)
    two = spark.createDataFrame([(2, "b")], "k int, v string")
    with pytest.raises(OSError):
        merge.safe_upsert(base, two, ["k"])
    assert rows(merge.read_table(spark, base), "k", "v") == [(1, "a")]
    monkeypatch.setattr(merge, "_point_at", point)
    merge.safe_upsert(base, two, ["k"])
    assert rows(merge.read_table(spark, base), "k", "v") == [(1, "a"), (2, "b")]
    assert merge.read_table(spark, f"{tmp}/none") is None
