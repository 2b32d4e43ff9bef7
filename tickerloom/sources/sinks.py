"""Writers: typed projection, full refresh, partitioned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.parse import last_path_segment, year_of_text
from tickerloom.schemas import GOLD
from tickerloom.session import remove_folder


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the stored column list and types; columns the frame lacks become NULL."""
    have = {f.name: f.dataType for f in df.schema}

    def cast(field: T.StructField) -> Column:
        value = F.col(field.name) if field.name in have else F.lit(None)
        if isinstance(field.dataType, T.DecimalType) and isinstance(have.get(field.name), T.DoubleType):
            # a decimal of a double is made from its digits as text: zeros, most of wide rows, need not be
            return F.when(value == 0, F.lit(0).cast(field.dataType)).otherwise(value.cast(field.dataType))
        return value.cast(field.dataType)

    return df.select(*[cast(f).alias(f.name) for f in schema])


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _refreshes(spark: SparkSession, folder: str) -> dict[int, dict[str, int]]:
    """Of every complete refresh, the refresh that wrote each table."""
    try:
        rows = spark.read.parquet(f"{folder}/manifest").collect()
    except AnalysisException:          # nothing is there yet
        return {}
    out: dict[int, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["refresh"], {})[r["name"]] = r["written"]
    return out


def full_refresh(frames: Mapping[str, DataFrame], folder: str, keep: int = 2) -> list[str]:
    """Replace the gold tables all at once; empty frames leave the table as it was, unknown names are
    refused.  Frames are cast to the declared types at this point only.

    All tables are written under a new refresh, then one manifest file names them: readers
    (``gold_table``) see the refresh before or this one, whatever fails in between.  The files of the
    newest ``keep`` refreshes stay, for readers that began earlier.
    """
    unknown = sorted(set(frames) - set(GOLD))
    if unknown:
        raise ValueError(f"unknown gold tables: {', '.join(unknown)}")
    if not frames:
        return []
    spark = next(iter(frames.values())).sparkSession
    before = _refreshes(spark, folder)
    number = max(before, default=-1) + 1
    entries = dict(before.get(number - 1, {}))
    written = []
    for name in (n for n in GOLD if n in frames):
        path = f"{folder}/data/refresh={number}/{name}"
        write_table(typed(frames[name], GOLD[name]), path)
        if not spark.read.schema(GOLD[name]).parquet(path).isEmpty():
            entries[name] = number
            written.append(name)
    spark.createDataFrame(sorted(entries.items()), "name string, written int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{folder}/manifest/refresh={number}")
    kept = {n: before[n] for n in before if n > number - keep} | {number: entries}
    used = {r for names in kept.values() for r in names.values()} | set(kept)
    for old in sorted(set(before) - set(kept)):
        remove_folder(spark, f"{folder}/manifest/refresh={old}")
        if old not in used:
            remove_folder(spark, f"{folder}/data/refresh={old}")
    return written


def gold_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as of the newest complete refresh."""
    refreshes = _refreshes(spark, folder)
    written = refreshes[max(refreshes)][name]
    return spark.read.schema(GOLD[name]).parquet(f"{folder}/data/refresh={written}/{name}")


def object_layout(items: DataFrame, file_url: str, date_text: str, root: str = "ammc") -> DataFrame:
    """Adds ``year``, ``filename`` and ``object_name`` (root/year/filename) for each file URL."""
    year, name = year_of_text(F.coalesce(F.col(date_text), F.lit(""))), last_path_segment(F.col(file_url))
    return items.where(F.coalesce(F.col(file_url), F.lit("")) != "").select(
        "*", year.alias("year"), name.alias("filename"), F.concat_ws("/", F.lit(root), year, name).alias("object_name")
    )


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``): the first failed rule names the reason.

    A rule is a condition that must be true.
    """
    reason = F.lit(None).cast("string")
    for name, holds in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    checked = df.withColumn("reject_reason", reason)
    return (
        checked.where("reject_reason IS NULL").drop("reject_reason"),
        checked.where("reject_reason IS NOT NULL"),
    )


def write_measured(df: DataFrame, rules: Mapping[str, Column], folder: str, run_id: str, pipeline: str = "load") -> DataFrame:
    """Write valid and rejected rows in one pass and append what was written to the run log.

    ``folder/rows/run_id=...`` holds all rows under ``rejected=false`` and ``rejected=true``, the rejected
    ones with their first failed rule; a run that is repeated replaces its rows.  The counts (rows read,
    kept, rejected per rule) come from one column of the written files; ``df`` is computed once.  They do
    not come from an observation on the plan: once a session has made one, Spark can no longer send models
    fitted in that session to its tasks.  ``folder/run_events`` grows by one event per count; the events
    of this run are returned.
    """
    spark = df.sparkSession
    reason = F.lit(None).cast("string")
    for name, holds in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    path = f"{folder}/rows/run_id={run_id}"
    checked = df.withColumn("reject_reason", reason).withColumn("rejected", F.col("reject_reason").isNotNull())
    checked.write.mode("overwrite").partitionBy("rejected").parquet(path)
    outcomes = spark.read.schema("reject_reason string").parquet(path).groupBy("reject_reason").count().collect()   # one row per rule
    found = {r["reject_reason"]: r["count"] for r in outcomes}
    counts = {"read": sum(found.values()), "kept": found.get(None, 0)} | {f"rejected_{name}": found.get(name, 0) for name in rules}
    rows = [(run_id, pipeline, "warning" if name.startswith("rejected_") and n else "info", "write", name, float(n)) for name, n in counts.items()]
    events = spark.createDataFrame(rows, "run_id string, pipeline_name string, level string, stage string, metric_name string, metric_value double")
    events.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{folder}/run_events")
    return spark.read.parquet(f"{folder}/run_events").where(F.col("run_id") == run_id)
