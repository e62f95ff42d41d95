"""Total order, reports with totals and the modifier tree (SRT-01, SNK-04, REC-03)."""

import csv
import glob
import os
import random

import pytest

from tavola.operators import recursive
from tavola.operators.ordering import number_rows, sort_keys
from tavola.plans import pos
from tavola.sources import sinks
from tavola.sources.mart import Mart


def test_row_numbers_follow_mixed_directions_over_tasks(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("abc") if rnd.random() < 0.9 else None, rnd.choice([1.0, 2.0, 3.0, None]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "a string, b double, c long").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(df, ["a", ("b", "desc"), "c"], "n")
        got = {r.n: (r.a, r.b, r.c) for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, -(r[1] or 0), r[2]))
    assert [got[k] for k in range(1, 4001)] == want and len(got) == 4000
    assert number_rows(df.limit(0), ["c"]).count() == 0
    with pytest.raises(ValueError):
        sort_keys([("a", "sideways")])


def test_report_files_are_sorted_end_to_end_with_totals(spark, tmp):
    rnd = random.Random(5)
    rows = [(rnd.choice(["A", "A", "A", "B"]), rnd.choice(["Entree", "Salad"]), f"i{i}", float(rnd.randrange(90)), float(rnd.randrange(9)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "location string, category2 string, item string, sales double, total_cost double").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for run in ("one", "two"):
            sinks.write_report(df, os.path.join(tmp, run), ["location"], [("sales", "desc"), "item"], ["category2"],
                               ["sales", "total_cost"], {"cost_pct": ("total_cost", "sales", 1.0)})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for store in "AB":
        read = []
        files = sorted(glob.glob(os.path.join(tmp, "one", f"location={store}", "part-*.csv")))
        for f in files:
            read += list(csv.DictReader(open(f)))
        want = []
        for cat in ("Entree", "Salad"):
            mine = sorted((r for r in rows if r[:2] == (store, cat)), key=lambda r: (-r[3], r[2]))
            want += [(cat, r[2], r[3], "item") for r in mine] + [(cat, "", sum(r[3] for r in mine), "Total")]
        assert [(r["category2"], r["item"], float(r["sales"]), r["row_type"]) for r in read] == want
        again = sorted(glob.glob(os.path.join(tmp, "two", f"location={store}", "part-*.csv")))
        assert [r for f in again for r in csv.DictReader(open(f))] == read  # whatever the bounds of the files
    assert len(glob.glob(os.path.join(tmp, "one", "location=A", "part-*.csv"))) > 1


def test_tree_documents_are_parsed_once(spark, monkeypatch):
    plans = []
    real = recursive.materialise

    def spy(df, checkpoint):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().lower())
        return real(df, checkpoint)
    monkeypatch.setattr(recursive, "materialise", spy)
    monkeypatch.setattr(pos, "materialise", spy)
    out = pos.product_mix_rows(Mart(spark, "/root/testdata/sf0.001"))
    parses = [p for p in plans if "from_json" in p or "jsontostructs" in p or "parse_json" in p]
    assert len(parses) == 1 and len(plans) == 3  # the selections, and two levels of modifiers
    final = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "from_json" not in final and "jsontostructs" not in final


def test_deep_and_odd_modifier_trees(spark):
    import json
    deep = None
    for i in range(12):
        deep = {"displayName": f"d{i}", "item": {"guid": f"g{i}"}, "quantity": 1, "price": 1.0, "modifiers": [deep] if deep else []}
    odd = [{"displayName": "no item", "modifiers": [deep]}, {"item": {"guid": "x"}, "quantity": "many", "price": 2.5, "modifiers": {"a": 1}}]
    order = {"businessDate": 20240131, "store_id": 1, "checks": [{"selections": [
        {"displayName": "Burger", "item": {"guid": "b"}, "quantity": 2, "price": 9.5, "preDiscountPrice": 10, "receiptLinePrice": 5,
         "modifiers": [deep, *odd]}, {"displayName": "Void", "voided": True, "item": {"guid": "v"}}]}]}
    docs = spark.createDataFrame([(json.dumps(order),), ("{}",), ("no json",)], "json string")

    class Landed:
        pass
    real, pos.landed_orders = pos.landed_orders, lambda m: docs
    try:
        rows = pos.product_mix_rows(Landed()).collect()
    finally:
        pos.landed_orders = real
    got = sorted((r.item_guid, r.item_name, r.qty, r.net) for r in rows)
    want = [("b", "Burger", 2.0, 9.5), ("x", "Unknown Modifier", 0.0, 2.5)] + [(f"g{i}", f"d{i}", 1.0, 1.0) for i in range(12)]
    assert got == sorted(want)
