import datetime

import pytest
from pyspark.sql import functions as F

from tickerloom.streaming import feed as ST

SCHEMA = "k string, n long, ts timestamp"
DAY = datetime.datetime(2024, 1, 1)


def at(days):
    return DAY + datetime.timedelta(days=days)


def files(spark, folder, batches, schema=SCHEMA):
    """One file per batch, in order; each is a micro-batch."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return ST.read_feed(spark, folder, spark.createDataFrame([], schema).schema, "ts", files_per_batch=1)


@pytest.fixture
def feed(spark, tmp_path):
    batches = [
        [("a", 1, at(0)), ("a", 2, at(0.5)), ("b", 3, at(1))],
        [("a", 4, at(4)), ("a", 5, at(0.7))],                 # the second row is late, within the lateness
        [("b", 6, at(9)), ("b", 7, at(9.5)), ("a", 8, at(8.9))],
    ]
    return files(spark, str(tmp_path / "feed"), batches)


def test_windows_open_at_the_end_are_there(spark, feed):
    windows = ST.windowed(feed, "ts", ["k"], [F.count("*").alias("rows"), F.sum("n").alias("total")], "1 day")
    got = {(r.k, r.start.day, r.rows, r.total) for r in ST.drain_windows(windows, ["k"], "w").collect()}
    assert got == {("a", 1, 3, 8), ("b", 2, 1, 3), ("a", 5, 1, 4), ("b", 10, 2, 13), ("a", 9, 1, 8)}


def test_append_mode_leaves_open_windows_out(spark, feed):
    windows = ST.windowed(feed, "ts", ["k"], [F.count("*").alias("rows")], "1 day", lateness="1 day")
    closed = {(r.k, r.start.day) for r in ST.drain(windows, "closed").collect()}
    assert closed == {("a", 1), ("b", 2), ("a", 5)}           # the windows of the last days are still open


def test_items_still_waiting_at_the_end_are_there(spark, tmp_path):
    items = files(spark, str(tmp_path / "items"), [[("a", 1, at(0)), ("b", 2, at(0.1))], [("c", 3, at(20)), ("d", 4, at(20.1)), ("a", 5, at(20.2))]])
    results = files(spark, str(tmp_path / "results"), [[("a", 10, at(0.5)), ("a", 11, at(0.6))], [("c", 12, at(20.4)), ("d", 13, at(29))]])
    joined = ST.pending_rows(
        items.select("k", "n", F.col("ts").alias("begun")), results.select("k", F.col("n").alias("result"), F.col("ts").alias("done")),
        "k", "begun", "done", "1 day")
    got = sorted(((r.n, r.result) for r in ST.drain_pending(joined.select("n", "result"), "n", "p").collect()), key=str)
    assert got == sorted([(1, 10), (1, 11), (2, None), (3, 12), (4, None), (5, None)], key=str)


def test_latest_state_takes_the_newest_change(spark):
    changes = spark.createDataFrame([("a", 1, 0), ("a", 5, 2), ("a", 3, 1), ("b", 9, 0)], "k string, n int, batch int")
    assert sorted(ST.latest_state(changes, ["k"]).collect()) == [("a", 5), ("b", 9)]
