"""Data-quality checks that ride on the write (DQ-01 .. DQ-05, DQ-08)."""

import os

import pytest

from tavola.operators.quality import DataQualityError, checked, read_checked, write_checked

ROWS = [(1, "d1", "Food"), (2, None, "Food"), (3, "d1", "Fuel"), (3, "d2", "Food"), (None, "d1", None),
        (None, "d2", "Food"), (4, None, "Fuel"), (5, "d5", "Food")]


def by_hand(rows):
    ids = [r[0] for r in rows]
    out = []
    for i, day, cat in rows:
        p = (["null day"] if day is None else []) + (["duplicate key"] if i is not None and ids.count(i) > 1 else [])
        out.append(sorted(p + (["unmapped cat"] if cat not in (None, "Food") else [])))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, day string, cat string")


def rules(spark):
    return {"not_null": ["day"], "unique": ["id"], "mapped": {"cat": (spark.createDataFrame([("Food",), (None,), ("Food",)], "k string"), "k")}}


def jobs(spark, run):
    sc = spark.sparkContext
    sc.setJobGroup("checks", "checks")
    try:
        out = run()
        return out, len(sc.statusTracker().getJobIdsForGroup("checks"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_marks_counts_and_quarantine(spark, tmp):
    df = frame(spark, ROWS)
    got = sorted((((r.id, r.day, r.cat), sorted(r.problems)) for r in checked(df, **rules(spark)).collect()), key=str)
    assert got == sorted(((r, p) for r, p in zip(ROWS, by_hand(ROWS))), key=str)
    path = os.path.join(tmp, "t")
    counts = write_checked(df, path, **rules(spark))
    want = by_hand(ROWS)
    assert counts == {"rows": 8, **{n: sum(n in p for p in want) for n in ("null day", "duplicate key", "unmapped cat")}}
    good, bad = read_checked(spark, path, df.schema), read_checked(spark, path, df.schema, good=False)
    assert good.columns == df.columns and good.count() == sum(not p for p in want)
    assert sorted(sorted(r.problems) for r in bad.collect()) == sorted(p for p in want if p)


def test_one_pass(spark, tmp):
    """Checks and write are one action: the input is read once, and nothing is counted before or after."""
    path = os.path.join(tmp, "in")
    frame(spark, ROWS * 50).write.parquet(path)
    df = spark.read.parquet(path)
    marked = checked(df, not_null=["day", "cat"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    counts, n = jobs(spark, lambda: write_checked(df, os.path.join(tmp, "out"), not_null=["day", "cat"]))
    assert counts == {"rows": 400, "null day": 100, "null cat": 50} and n == 1


def test_failures(spark, tmp):
    df = frame(spark, ROWS)
    with pytest.raises(DataQualityError, match="2 rows: null day"):
        write_checked(df, os.path.join(tmp, "a"), not_null=["day"], fail_on=["null day"])
    assert read_checked(spark, os.path.join(tmp, "a"), df.schema, good=False).count() == 2
    assert write_checked(df, os.path.join(tmp, "b"), not_null=["cat"], fail_on=["null day"])["null cat"] == 1
    with pytest.raises(DataQualityError, match="empty"):
        write_checked(df.limit(0), os.path.join(tmp, "c"), not_null=["day"])
    assert write_checked(df.limit(0), os.path.join(tmp, "d"), not_null=["day"], allow_empty=True) == {"rows": 0, "null day": 0}
    assert read_checked(spark, os.path.join(tmp, "d"), df.schema).count() == 0
    assert checked(df).filter("size(problems) = 0").count() == 8
