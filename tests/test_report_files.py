"""Report CSV with quoted line breaks against Python's csv module (SRC-01)."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import types as T

from tavola.sources import files

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("note", T.StringType()), T.StructField("qty", T.DoubleType())])


@pytest.fixture()
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, ("512", "1", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def report(seed, rows, breaks=0.3, end="\n"):
    rnd = random.Random(seed)
    words = ["Bun", "Beef, ground", 'the "best"', "", "x" * 40, "ä", "a b"]
    out = io.StringIO()
    out.write(end.join(["Receiving", "Store 1", ""]) + end)
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    w.writerow(["name", "note", "qty"])
    for i in range(rows):
        note = rnd.choice(words)
        if rnd.random() < breaks:
            note = "\n".join(rnd.choice(words) for _ in range(rnd.choice([2, 3, 3, 60])))
        w.writerow([f"{rnd.choice(words)}{i}", note, f"{rnd.randrange(5000):,}"])
    return out.getvalue()


def by_csv(text):
    rows = list(csv.reader(io.StringIO(text)))[4:]
    return [(r[0], r[1], float(r[2].replace(",", ""))) for r in rows if r]


def read(spark, path):
    rows = files.read_report_csv(spark, path, SCHEMA).orderBy("_ord").collect()
    return [(r.name or "", r.note or "", r.qty) for r in rows]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_over_many_blocks(spark, tmp, small_blocks, end):
    text = report(3, 400, end=end)
    path = os.path.join(tmp, "a.csv")
    with open(path, "w", newline="") as f:
        f.write(text)
    lines = files._file_lines(spark, path)
    assert lines.select("_block").distinct().count() > 20
    want = by_csv(text)
    got = read(spark, path)
    assert sorted(got) == sorted(want) and len(want) == 400
    assert any("\n" in n and len(n) > 600 for _, n, _ in want)  # a record over several blocks


def test_several_files_each_with_its_own_quotes(spark, tmp, small_blocks):
    want = []
    for n, (rows, breaks) in enumerate([(60, 0.5), (50, 0.0), (0, 0.0), (30, 1.0), (1, 1.0)]):
        text = report(n, rows, breaks)
        want += by_csv(text)
        with open(os.path.join(tmp, f"r{n}.csv"), "w", newline="") as f:
            f.write(text)
    assert sorted(read(spark, tmp)) == sorted(want)


def test_header_and_blank_lines(spark, tmp):
    path = os.path.join(tmp, "b.csv")
    with open(path, "w", newline="") as f:
        f.write('one\ntwo "quoted\nname"\n\nname,"no\nte",qty\nA,"x\n\ny",1\n\n"B ""b""",,"(2,000.50)"\nC,"never closed,3\n\nrest')
    got = read(spark, path)
    assert got == [("A", "x\n\ny", 1.0), ('B "b"', "", -2000.5), ("C", "never closed,3\n\nrest", None)]


def test_simple_blocks_are_not_windowed(spark, tmp):
    path = os.path.join(tmp, "c.csv")
    with open(path, "w", newline="") as f:
        f.write(report(1, 50, 0.0))
    assert len(read(spark, path)) == 50
