"""The delivery log: repeats, late corrections, restarts (INC-01, INC-02)."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from tavola.streaming.incremental import current_rows, upsert_log

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("store", T.StringType()), T.StructField("day", T.StringType()),
                       T.StructField("summary", T.StringType()), T.StructField("amount", T.DoubleType()),
                       T.StructField("sent", T.TimestampType())])
KEYS = ["id", "store", "day", "summary"]


def at(day):
    return dt.datetime(2024, 1, 1, 6) + dt.timedelta(days=day)


@pytest.fixture()
def feed(spark, tmp):
    landing, log, checkpoint = (os.path.join(tmp, x) for x in ("landing", "log", "checkpoint"))

    class Feed:
        def land(self, *rows):
            spark.createDataFrame([(i, s, d, v, a, at(t)) for i, s, d, v, a, t in rows], SCHEMA).coalesce(1).write.mode("append").parquet(landing)

        def run(self, after_batch=None):
            upsert_log(spark, landing, SCHEMA, log, checkpoint, KEYS, "sent", "7 days", after_batch=after_batch).awaitTermination()

        def rows(self):
            return spark.read.schema(SCHEMA).parquet(log)

        def table(self):
            now = current_rows(self.rows(), ["id"], ["store", "day"], "summary", "sent")
            return sorted((r.id, r.store, r.day, r.summary, r.amount) for r in now.collect())

        def batches(self):
            return sorted(x for x in os.listdir(log) if x.startswith("batch="))
    return Feed()


def test_repeats_and_late_corrections(feed):
    feed.land((1, "L", "d1", "a", 1.0, 1), (2, "L", "d1", "a", 2.0, 1), (3, "M", "d1", "a", 3.0, 1), (3, "M", "d1", "a", 3.0, 2))
    feed.run()
    assert feed.table() == [(1, "L", "d1", "a", 1.0), (2, "L", "d1", "a", 2.0), (3, "M", "d1", "a", 3.0)]
    assert feed.rows().count() == 3
    # line 1 again; the store's day under a new summary without line 2; line 3 booked to another store
    feed.land((1, "L", "d1", "a", 1.0, 3), (1, "L", "d1", "b", 1.5, 4), (3, "L", "d2", "b", 3.5, 4))
    feed.run()
    assert feed.table() == [(1, "L", "d1", "b", 1.5), (3, "L", "d2", "b", 3.5)]
    assert feed.rows().count() == 5
    feed.run()  # nothing landed
    assert len(feed.table()) == 2


def test_a_batch_that_failed_is_applied_once(feed):
    def fail(number):
        raise RuntimeError("the driver is lost here")
    feed.land((1, "L", "d1", "a", 1.0, 1), (2, "L", "d1", "a", 2.0, 1))
    feed.run()
    feed.land((4, "L", "d3", "a", 4.0, 5), (1, "L", "d1", "a", 1.0, 5))
    with pytest.raises(Exception, match="the driver is lost here"):
        feed.run(after_batch=fail)
    filed = feed.batches()
    feed.run()
    assert feed.batches()[:len(filed)] == filed
    assert sorted(r.id for r in feed.rows().collect()) == [1, 2, 4]
    assert feed.table() == [(1, "L", "d1", "a", 1.0), (2, "L", "d1", "a", 2.0), (4, "L", "d3", "a", 4.0)]


def test_the_memory_of_repeats_is_bounded_by_the_delay(feed):
    feed.land((1, "L", "d1", "a", 1.0, 1))
    feed.run()
    feed.land((2, "L", "d1", "a", 2.0, 100))
    feed.run()
    feed.land((3, "L", "d1", "a", 3.0, 101))
    feed.run()
    feed.land((1, "L", "d1", "b", 1.0, 102), (2, "L", "d1", "a", 2.0, 102))
    feed.run()
    assert sorted((r.id, r.summary) for r in feed.rows().collect()) == [(1, "a"), (1, "b"), (2, "a"), (3, "a")]
    assert feed.table() == [(1, "L", "d1", "b", 1.0)]
