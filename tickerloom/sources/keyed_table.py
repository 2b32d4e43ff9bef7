"""A keyed table on shared storage whose writes touch only the buckets they change.

Rows lie in hash buckets of their key, a folder each.  A write reads the buckets that its rows fall in,
writes those anew under its version, and then one manifest file that names a folder for every bucket: a
reader sees the old table or the new one, and a write that failed leaves files nobody reads.  Version N
depends on version N - 1 and the rows of the write alone, so a repeated write gives the same table.
There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.session import remove_folder, stored

ROWS_PER_BUCKET = 1_000_000
_BUCKET = "_bucket"


class KeyedTable:
    """``schema`` and ``keys`` are the table's; the number of buckets is fixed when it is created."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.folder, self.schema, self.keys = spark, folder, schema, list(keys)

    @classmethod
    def create(cls, rows: DataFrame, folder: str, keys: Sequence[str], buckets: int | None = None) -> KeyedTable:
        """Version 0 from ``rows``, whose keys must be unique; by default a bucket per
        ``ROWS_PER_BUCKET`` rows."""
        table = cls(rows.sparkSession, folder, rows.schema, keys)
        if buckets is None:
            rows = stored(rows, "keyed-rows")
            buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
        table._write(rows, 0, buckets, {})
        return table

    # --- versions ----------------------------------------------------------------------

    def version(self) -> int:
        """The newest complete version."""
        return self.spark.read.parquet(f"{self.folder}/manifest").agg(F.max("version")).first()[0]

    def _manifest(self, version: int) -> tuple[int, dict[int, int]]:
        """Number of buckets, and of every bucket with rows the version that wrote it."""
        rows = self.spark.read.parquet(f"{self.folder}/manifest/version={version}").collect()
        return rows[0]["buckets"], {r["bucket"]: r["written"] for r in rows if r["bucket"] >= 0}

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int, buckets: int, kept: dict[int, int]) -> None:
        path = f"{self.folder}/data/version={version}"
        rows.select(*self.schema.names).withColumn(_BUCKET, self._bucket(buckets)).repartition(_BUCKET) \
            .write.mode("overwrite").partitionBy(_BUCKET).parquet(path)
        written = self.spark.read.schema(f"{_BUCKET} int").parquet(path).select(_BUCKET).distinct().collect()
        entries = kept | {r[0]: version for r in written}
        self.spark.createDataFrame(
            [(buckets, -1, version), *((buckets, b, v) for b, v in sorted(entries.items()))], "buckets int, bucket int, written int"
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/version={version}")

    def _rows(self, entries: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/data/version={v}/{_BUCKET}={b}" for b, v in sorted(entries.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # --- reading and writing -----------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version; by default the newest complete one."""
        return self._rows(self._manifest(self.version() if version is None else version)[1])

    def merge(self, updates: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None) -> int:
        """Write ``combine(old rows, updates)`` for the buckets that ``updates`` fall in.

        ``combine`` must keep rows under their keys, as the functions of ``sources.upsert`` do.
        ``version`` names the version to write, for writers that repeat a write after a failure.
        """
        version = self.version() + 1 if version is None else version
        buckets, entries = self._manifest(version - 1)
        updates = stored(updates, "updates")
        touched = {r[0] for r in updates.select(self._bucket(buckets)).distinct().collect()}
        old = self._rows({b: v for b, v in entries.items() if b in touched})
        self._write(combine(old, updates), version, buckets, {b: v for b, v in entries.items() if b not in touched})
        return version

    def replace(self, rows: DataFrame, version: int | None = None) -> int:
        """All new rows, as a new version with the same number of buckets."""
        version = self.version() + 1 if version is None else version
        self._write(rows, version, self._manifest(version - 1)[0], {})
        return version

    def rehash(self, buckets: int) -> int:
        """The same rows in another number of buckets, as a new version."""
        version = self.version() + 1
        self._write(self.read(version - 1), version, buckets, {})
        return version

    def vacuum(self, keep: int = 2) -> None:
        """Remove what the newest ``keep`` versions do not use; their readers go on undisturbed."""
        newest = self.version()
        kept = [v for v in range(max(0, newest - keep + 1), newest + 1)]
        used = {v for k in kept for v in self._manifest(k)[1].values()} | set(kept)
        live = {(v, b) for k in kept for b, v in self._manifest(k)[1].items()}
        older = self.spark.read.parquet(f"{self.folder}/manifest").where(F.col("version") < kept[0]).select("version").distinct()
        for v in sorted(r[0] for r in older.collect()):
            if v not in used:
                remove_folder(self.spark, f"{self.folder}/manifest/version={v}")
            if v not in used:
                remove_folder(self.spark, f"{self.folder}/data/version={v}")
                continue
            data = self.spark.read.schema(f"{_BUCKET} int").parquet(f"{self.folder}/data/version={v}")
            for r in data.select(_BUCKET).distinct().collect():
                if (v, r[0]) not in live:
                    remove_folder(self.spark, f"{self.folder}/data/version={v}/{_BUCKET}={r[0]}")
