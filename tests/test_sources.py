import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.operators import merge
from tavola.sources import files, sinks
from tavola.streaming.incremental import incremental_upsert


def test_read_report_csv(spark, tmp):
    p = os.path.join(tmp, "report.csv")
    with open(p, "w") as f:
        f.write("Product Mix\nStore X\n\nItemName,Quantity,AmountEach\n")
        f.write('Burger,"1,234",(2.50)\nFries,3,1.25\n\n')
    schema = T.StructType([T.StructField("ItemName", T.StringType()),
                           T.StructField("Quantity", T.DoubleType()),
                           T.StructField("AmountEach", T.DoubleType())])
    df = files.read_report_csv(spark, p, schema)
    got = sorted((r.ItemName, r.Quantity, r.AmountEach) for r in df.collect())
    assert got == [("Burger", 1234.0, -2.5), ("Fries", 3.0, 1.25)]


def test_read_json_pages_list_and_scalar(spark, tmp):
    d = os.path.join(tmp, "pages")
    os.makedirs(d)
    with open(os.path.join(d, "p1.json"), "w") as f:
        json.dump({"value": [{"id": "a", "n": 1}, {"id": "b", "n": 2}], "@odata.nextLink": "x"}, f)
    with open(os.path.join(d, "p2.json"), "w") as f:
        json.dump({"value": {"id": "c", "n": 3}}, f)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    df = files.read_json_pages(spark, d, schema, "value")
    assert sorted((r.id, r.n) for r in df.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_unwrap_records(spark):
    docs = spark.createDataFrame([('[{"id": "a"}]',), ('{"meta": 1, "items": [{"id": "b"}, {"id": "c"}]}',),
                                  ('{"id": "d"}',)], "j string")
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert sorted(r.id for r in files.unwrap_records(docs, "j", schema).collect()) == ["a", "b", "c", "d"]


def test_read_lines_and_missing(spark, tmp):
    p = os.path.join(tmp, "list.txt")
    with open(p, "w") as f:
        f.write("  Soup \n\nSalad\nSoup\n")
    assert sorted(r.name for r in files.read_lines(spark, p).collect()) == ["Salad", "Soup", "Soup"]
    assert files.read_lines(spark, os.path.join(tmp, "nope.txt")).count() == 0


def test_sinks_and_partitioned_read(spark, tmp):
    df = spark.createDataFrame([("A", "Entree", 1.0), ("B", "Dessert", 2.0)], "location string, category2 string, v double")
    sinks.write_report(df, os.path.join(tmp, "rep"), order_by=["v"])
    back = spark.read.option("header", True).csv(os.path.join(tmp, "rep"))
    assert sorted((r.location, r.category2) for r in back.collect()) == [("A", "Entree"), ("B", "Dessert")]
    sinks.overwrite(df, os.path.join(tmp, "part"), partition_by=["location"])
    p = files.read_partitioned(spark, os.path.join(tmp, "part"))
    assert p.filter(F.col("location") == "A").count() == 1
    sinks.write_bundle({"one": df, "two": df}, os.path.join(tmp, "bundle"))
    assert os.path.isdir(os.path.join(tmp, "bundle", "two"))


def test_versioned_table(spark, tmp):
    base = os.path.join(tmp, "tbl")
    a = spark.createDataFrame([(1, 1.0)], "id int, v double")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, v double")
    p1 = merge.write_version(a, base)
    p2 = merge.write_version(merge.upsert(merge.read_table(spark, base), b, ["id"]), base)
    assert p1 != p2
    assert sorted(tuple(r) for r in merge.read_table(spark, base).collect()) == [(1, 2.0), (2, 3.0)]


def test_streaming_incremental_upsert(spark, tmp):
    landing, table, ck = (os.path.join(tmp, x) for x in ("landing", "table", "ck"))
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("loc", T.StringType()),
                           T.StructField("d", T.StringType()), T.StructField("version", T.StringType()),
                           T.StructField("amount", T.DoubleType())])
    spark.createDataFrame([(1, "L", "d1", "v1", 1.0), (2, "L", "d2", "v1", 2.0)], schema) \
        .write.parquet(os.path.join(landing, "b1"))
    q = incremental_upsert(spark, landing + "/*", schema, table, ck, ["id"], ["loc", "d"], "version")
    q.awaitTermination(120)
    # a late correction re-sends day d1 under a new version
    spark.createDataFrame([(3, "L", "d1", "v2", 5.0)], schema).write.parquet(os.path.join(landing, "b2"))
    q = incremental_upsert(spark, landing + "/*", schema, table, ck, ["id"], ["loc", "d"], "version")
    q.awaitTermination(120)
    got = sorted((r.id, r.version) for r in merge.read_table(spark, table).collect())
    assert got == [(2, "v1"), (3, "v2")]


def test_read_csv_many_files_with_file_attribute(spark, tmp):
    d = os.path.join(tmp, "budgets")
    os.makedirs(d)
    for name, amt in (("store_a.csv", 1.5), ("store_b.csv", 2.5)):
        with open(os.path.join(d, name), "w") as f:
            f.write(f"Account,Amount\n4000 - Sales,{amt}\n")
    schema = T.StructType([T.StructField("Account", T.StringType()), T.StructField("Amount", T.DoubleType())])
    df = files.read_csv(spark, os.path.join(d, "*.csv"), schema)
    mapping = spark.createDataFrame([("store_a.csv", "A"), ("store_b.csv", "B")], "file_name string, location string")
    got = sorted((r.location, r.Amount) for r in files.with_file_attribute(df, mapping).collect())
    assert got == [("A", 1.5), ("B", 2.5)]


def test_json_pages_one_document_per_line(spark, tmp):
    import pathlib
    from pyspark.sql import types as T
    from tavola.sources.files import broken_json_pages, read_json_pages
    pathlib.Path(tmp, "a.json").write_text('{"value": [{"id": 1}, {"id": 2}]}\n{"value": {"id": 3}}\n')
    pathlib.Path(tmp, "b.json").write_text('{\n "value": [\n {"id": 4}\n ]\n}\n')
    pathlib.Path(tmp, "c.json").write_text('{"other": 1}')
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert sorted(r.id for r in read_json_pages(spark, tmp, schema).collect()) == [1, 2, 3, 4]
    assert [r.file[-6:] for r in broken_json_pages(spark, tmp).collect()] == ["c.json"]


def test_partitions_that_a_batch_does_not_hold_are_not_rewritten(spark, tmp):
    from tavola.streaming.incremental import apply_batch
    schema = "id int, loc string, d date, version string, amount double"
    def rows(*r):
        import datetime as dt
        return spark.createDataFrame([(i, "L", dt.date(2024, 1, day) if day else None, v, a) for i, day, v, a in r], schema)
    base = os.path.join(tmp, "t")
    def send(*r):
        apply_batch(spark, base, rows(*r), ["id", "d"], ["loc", "d"], "version", partition="d")
        return merge.current_paths(spark, base)
    first = send((1, 1, "v1", 1.0), (2, 2, "v1", 2.0), (9, None, "v1", 9.0))
    second = send((3, 1, "v2", 5.0), (4, 3, "v1", 6.0))
    assert len(first) == 3 and len(second) == 4 and len(set(first) & set(second)) == 2
    got = sorted((r.id, r.version, r.amount) for r in merge.read_table(spark, base).collect())
    assert got == [(2, "v1", 2.0), (3, "v2", 5.0), (4, "v1", 6.0), (9, "v1", 9.0)]
    assert merge.read_table(spark, base).columns == ["id", "loc", "d", "version", "amount"]


def test_plain_sinks_and_simple_checks(spark, tmp):
    import pytest
    from tavola.operators.quality import DataQualityError, quarantine_split, require_not_null
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, v string")
    for _ in range(2):
        sinks.append(df, os.path.join(tmp, "t"))
    assert spark.read.parquet(os.path.join(tmp, "t")).count() == 6
    sinks.write_csv(df, os.path.join(tmp, "csv"), single_file=True)
    assert sorted(r.id for r in spark.read.option("header", True).schema("id long, v string").csv(os.path.join(tmp, "csv")).collect()) == [1, 2, 3]
    assert require_not_null(df, "id") is df
    with pytest.raises(DataQualityError):
        require_not_null(df, "v")
    good, bad = quarantine_split(df, F.col("v") == "c")
    assert [r.id for r in bad.collect()] == [3] and sorted(r.id for r in good.collect()) == [1, 2]
