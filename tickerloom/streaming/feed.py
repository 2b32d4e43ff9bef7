"""Structured Streaming forms of the polled feed: dedup, counters, windows, upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickerloom.session import work_folder
from tickerloom.sources.keyed_table import KeyedTable


CLEAN_EVERY = 10


def read_feed(spark: SparkSession, folder: str, schema: T.StructType, ts: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; event time becomes a zoned timestamp, which
    watermarks require."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn(ts, F.col(ts).cast("timestamp"))


def recent_only(feed: DataFrame, ts: str, days: int, as_of: Column | None = None) -> DataFrame:
    """Drop entries older than the look-back at arrival."""
    now = F.current_timestamp() if as_of is None else as_of
    return feed.where(F.col(ts) >= now - F.make_dt_interval(F.lit(days)))


def dedup_feed(feed: DataFrame, keys: Sequence[str], ts: str, lookback: str = "7 days") -> DataFrame:
    """First arrival per key; state is dropped once the look-back has passed."""
    return feed.withWatermark(ts, lookback).dropDuplicatesWithinWatermark(list(keys))


def windowed(feed: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column], length: str, slide: str | None = None, offset: str | None = None, lateness: str = "7 days") -> DataFrame:
    """Event-time windows.  Append mode emits them closed; a feed that ends leaves the last ones open,
    so a bounded feed is read by ``drain_windows``."""
    win = F.window(ts, length, slide or length, offset)
    return (
        feed.withWatermark(ts, lateness).groupBy(win, *keys).agg(*aggs)
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "*").drop("window")
    )


# Event-time weeks run Tuesday to Monday; the epoch was a Thursday, hence the offset.
WEEK_OFFSET = "5 days"


def running_counts(feed: DataFrame, key: str, ts: str, lateness: str = "14 days") -> DataFrame:
    """Count and first time per key, for update mode.

    The key's day-bucketed week joins the grouping so that state older than the watermark is
    released; a fingerprint already names one ISO week, so this splits no counter.
    """
    return feed.withWatermark(ts, lateness).groupBy(
        F.window(ts, "7 days", startTime="4 days"), key
    ).agg(F.count("*").alias("n"), F.min(ts).alias("first_seen")).select(
        key, F.col("window.start").alias("week"), "n", "first_seen"
    )


def sink(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Parquet sink that resumes from its checkpoint; without ``every`` it drains what is there
    and stops."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.format("parquet").option("path", folder).start()


def change_log(stream: DataFrame, folder: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Write every batch's changed rows under their batch number.

    Rewriting a batch after a failure replaces the same folder, so replays do not double rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(write).start()


def latest_state(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current value of every key in a change log, combined before the shuffle."""
    values = [c for c in changes.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("_newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def drain_windows(windows: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Every window of a bounded feed: the closed ones, and the open ones with what they hold.

    The stream runs in update mode into a change log; a window's newest change is its value, whether
    the watermark has passed it or the feed ended first.  State is released by the watermark as ever.
    """
    return latest_state(drain(windows, label, "update"), ["start", "end", *keys])


def upsert_stream(stream: DataFrame, table: KeyedTable, checkpoint: str, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> StreamingQuery:
    """Micro-batch upsert: batch N writes version N + 1 of the table, only the buckets it changes.

    Each version depends on the one before and its batch alone, so a replayed batch gives the same table.
    Versions older than the last two are removed every ``CLEAN_EVERY`` batches.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table.merge(batch, combine, number + 1)
        if number % CLEAN_EVERY == CLEAN_EVERY - 1:
            table.vacuum()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(apply).start()


def pending_rows(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, wait: str = "7 days", lateness: str = "7 days") -> DataFrame:
    """Stream-stream left join: items with no result within ``wait`` come out with NULL, once rows of
    that time can no longer arrive.  Rows up to ``lateness`` late are taken."""
    a = left.withWatermark(left_ts, lateness).alias("a")
    b = right.withColumnRenamed(key, "_rkey").withWatermark(right_ts, lateness).alias("b")
    return a.join(
        b,
        F.expr(f"{key} = _rkey AND {right_ts} >= {left_ts} AND {right_ts} <= {left_ts} + INTERVAL {wait}"),
        "left_outer",
    )


def drain_pending(joined: DataFrame, item: str, label: str) -> DataFrame:
    """All rows of a bounded ``pending_rows`` stream, items that still wait at its end included.

    What the stream emitted is read back; the items it still held in its last state and never emitted
    follow with NULL results.  ``item`` is a column of the items that names them.
    """
    spark = joined.sparkSession
    base = work_folder(spark, label)
    sink(joined, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    emitted = spark.read.schema(joined.schema).parquet(f"{base}/out")
    held = spark.read.format("statestore").option("joinSide", "left").load(f"{base}/checkpoint")
    waiting = held.select("value.*").join(emitted.select(item).distinct(), item, "left_anti")
    return emitted.unionByName(waiting.select(*[c for c in waiting.columns if c in emitted.columns]), allowMissingColumns=True)


def drain(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available and read its table back.

    Output and checkpoint live in the shared work folder; nothing passes through the driver.
    """
    spark = stream.sparkSession
    base = work_folder(spark, label)
    if mode == "append":
        sink(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{base}/out")
    change_log(stream, f"{base}/out", f"{base}/checkpoint", mode).awaitTermination()
    return spark.read.parquet(f"{base}/out")
