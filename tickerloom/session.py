"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for wide rows keyed by (ticker, date).  Generated code over 8,000 bytes of a method is never
# compiled to machine code, so such steps, and those on over 50 fields, run as split projections; and sides that a window has
# dealt by ticker are joined on (ticker, date) where they lie.
WIDE_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.maxFields": "50",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tuned(spark: SparkSession) -> SparkSession:
    """``spark`` with the settings for wide rows, but for those it was given."""
    for key, value in WIDE_CONF.items():
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)
    return spark


@contextmanager
def dealt_in(spark: SparkSession, parts: int) -> Iterator[None]:
    """Shuffles planned inside begin with at least ``parts`` parts, adaptive execution joins only small
    ones and files are read in small splits, but for settings the session was given.  All go by compressed
    bytes, and repeated keys, flags and one-hots shrink so well that a part of the default size spills."""
    given = spark.sparkContext.getConf()
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
        "spark.sql.files.maxPartitionBytes": "16m",
    }
    wanted = {key: value for key, value in wanted.items() if given.get(key) is None}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(app: str = "tickerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, adaptive execution and zstd parquet; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    The cluster names the shared folder.  Only a ``local[...]`` session, where driver and
    executors are one machine, may fall back to a temporary folder when the setting is absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tickerloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
