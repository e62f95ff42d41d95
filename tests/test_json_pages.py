"""Pages of any size and layout against Python's json module (SRC-05, SRC-06)."""

import json
import os
import random

import pytest
from pyspark.sql import types as T

from tavola.sources import files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("sub", T.StringType()), T.StructField("list", T.StringType())])
TEXTS = ["plain", 'a "quoted" } brace', "{[", "]}", "\\", "\\\\\" }", "ä\n}", '"value": [', "", ":", "x" * 300, '","value":[{"id":-1}]']


@pytest.fixture()
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, ("700", "1", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def record(rnd, i):
    r = {"id": i, "text": rnd.choice(TEXTS)}
    if rnd.random() < 0.6:
        r["sub"] = {"value": [{"id": -2}], "deep": [[rnd.choice(TEXTS), [1, 2]], {"a": {"}": rnd.choice(TEXTS)}}]}
    if rnd.random() < 0.4:
        r["list"] = [rnd.choice(TEXTS) for _ in range(3)]
    return r


def page(rnd, ids, single=False):
    d = {}
    extra = {"meta": {"count": 3, "value": {"id": -3}}, "tags": ["[", "}", ["value"]], "rows": [{"id": -4}, {"value": [{"id": -5}]}], "next": rnd.choice(TEXTS)}
    for k in rnd.sample(list(extra), rnd.randint(0, 4)):
        d[k] = extra[k]
    d["value"] = record(rnd, ids[0]) if single else [record(rnd, i) for i in ids]
    for k in rnd.sample(list(extra), rnd.randint(0, 4)):
        d.setdefault(k, extra[k])
    return d


def row(r):
    def text(v):
        return v if v is None or isinstance(v, str) else json.loads(json.dumps(v))
    return (r["id"], r["text"], text(r.get("sub")), text(r.get("list")))


def read(spark, path, **kw):
    out = []
    for r in files.read_json_pages(spark, path, SCHEMA, **kw).collect():
        out.append((r.id, r.text, *[v if v is None else json.loads(v) for v in (r["sub"], r["list"])]))
    return sorted(out, key=str)


@pytest.mark.parametrize("layout", [{"separators": (",", ":")}, {"indent": 2}, {"ensure_ascii": False}])
def test_one_large_page_over_many_tasks(spark, tmp, small_blocks, layout):
    rnd = random.Random(4)
    d = page(rnd, list(range(250)))
    path = os.path.join(tmp, "page.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(d, f, **layout)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    assert read(spark, path) == sorted(map(row, d["value"]), key=str)


def test_many_pages_of_all_kinds(spark, tmp, small_blocks):
    rnd = random.Random(9)
    want, n = [], 0
    for k in range(40):
        docs = []
        for _ in range(rnd.choice([1, 1, 3])):
            size = rnd.choice([0, 1, 2, 9])
            single = size == 1 and rnd.random() < 0.7
            d = page(rnd, list(range(n, n + size)), single)
            n += size
            want += [row(r) for r in ([d["value"]] if single else d["value"])]
            docs.append(json.dumps(d, indent=rnd.choice([None, None, 1]), ensure_ascii=rnd.random() < 0.5))
        with open(os.path.join(tmp, f"p{k}.json"), "w", encoding="utf-8") as f:
            f.write("\n".join(docs) + rnd.choice(["", "\n", "  \n\n"]))
    assert read(spark, tmp) == sorted(want, key=str)
    assert files.broken_json_pages(spark, tmp).count() == 0


def test_broken_pages(spark, tmp):
    pages = {"a": '{"value": [{"id": 1, "text": "x"}, {"id": 2, "te', "b": '{"other": [{"id": 3}]}', "c": '{"value": [{"id": 4, "text": "y"}]}',
             "d": '{"value": [{"id": 5, "text": "z"}, {"id": 6}', "e": '{"value": 7, "x": {"value": [{"id": 8}]}}', "f": '{"value": []}', "g": "no json"}
    for k, v in pages.items():
        with open(os.path.join(tmp, f"{k}.json"), "w") as f:
            f.write(v)
    assert [r[0] for r in read(spark, tmp)] == [1, 4, 5, 6]
    got = {os.path.basename(r.file): r.problem for r in files.broken_json_pages(spark, tmp).collect()}
    assert got == {"a.json": "cut off", "b.json": "no value", "d.json": "cut off", "e.json": "no value", "g.json": "no value"}


def test_lines_stand_alone(spark, tmp):
    with open(os.path.join(tmp, "l.json"), "w") as f:
        f.write('{"value": [{"id": 1, "text": "x"}]}\n{"value": [{"id": 2, "te\n\n{"value": {"id": 3, "text": "y"}}\n{"x": 1}\n')
    assert [r[0] for r in read(spark, tmp, lines=True)] == [1, 3]
    assert sorted(r.problem for r in files.broken_json_pages(spark, tmp, lines=True).collect()) == ["no JSON", "no value"]
