"""Readers: CSV, JSON, parquet, archived pages."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.constants import PRICE_HEADERS
from tickerloom.functions.parse import parse_day, parse_volume, to_number
from tickerloom.session import remove_folder


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text and trimmed headers."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def file_key(path: Column) -> Column:
    """Leading code of a "CODE - anything" file name; NULL for other names."""
    name = F.url_decode(F.element_at(F.split(path, "/"), -1))
    return F.nullif(F.regexp_extract(name, "^([A-Z0-9]+) - ", 1), F.lit(""))


def read_price_files(spark: SparkSession, pattern: str) -> DataFrame:
    """All price CSVs in one scan; the ticker comes from each file's name.

    Files without a code in their name and rows without a valid date are left out.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(pattern)
    raw = raw.select("*", file_key(F.col("_metadata.file_path")).alias("ticker")).where("ticker IS NOT NULL")
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    raw = raw.withColumnsRenamed(PRICE_HEADERS)
    return raw.select(
        "ticker",
        parse_day(F.col("date"), "yyyy-MM-dd", "dd/MM/yyyy").alias("date"),
        *[to_number(F.col(c)).alias(c) for c in ("close", "open", "high", "low")],
        parse_volume(F.col("volume")).alias("volume"),
        to_number(F.col("change_pct")).alias("change_pct"),
    ).where("date IS NOT NULL")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Column-pruned parquet scan; a missing path raises here, not at the first action."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    df.schema  # resolve the path now
    return df.select(*columns) if columns else df


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Fail fast on an empty or unreadable table; damaged files raise while reading a row."""
    if df.isEmpty():
        raise ValueError(f"{name}: no readable rows")
    return df


def schema_from_fields(fields: list[dict]) -> T.StructType:
    """Output schema from a field list with ``name`` and optional ``type`` and ``description``."""
    return T.StructType([
        T.StructField(
            f["name"], T.DataType.fromDDL(f.get("type", "string")), True,
            {"comment": f["description"]} if f.get("description") else None,
        )
        for f in fields
    ])


@F.pandas_udf(T.StringType())
def _gunzip(contents: pd.Series) -> pd.Series:
    def one(raw):
        try:
            return gzip.decompress(raw).decode("utf-8", errors="replace")
        except (OSError, EOFError, zlib.error):
            return None

    return contents.map(one)


def read_archived_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(raw_html_path, html) for every ``*.html.gz``; unreadable files give NULL html."""
    raw = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.html.gz")
        .option("recursiveFileLookup", True).load(folder)
    )
    relative = F.regexp_extract("path", r"(raw/.*)$", 1)
    return raw.select(relative.alias("raw_html_path"), _gunzip("content").alias("html"))


def write_archived_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages(raw_html_path, html)`` as gzip files, one per path, and return (raw_html_path, n_bytes).

    Tasks write through ``pyarrow.fs``, so ``folder`` may be on any store it knows.  Paths name content
    by its digest: a task that runs again writes the same files.  Call an action on the result, once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            sizes = []
            for path, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packed = gzip.compress((html or "").encode(), mtime=0)
                target.create_dir(f"{base}/{path.rpartition('/')[0]}")
                with target.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(packed)
                sizes.append(len(packed))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["raw_html_path", "n_bytes"])

    one = pages.where("raw_html_path is not null").select("raw_html_path", "html").dropDuplicates(["raw_html_path"])
    return one.mapInArrow(run, "raw_html_path string, n_bytes long")


def write_named_csv(rows: DataFrame, folder: str, name: str) -> None:
    """One CSV file per value of ``name``, which is the file's name; the number of names is the number of
    files, each written by one task.  Spark names its own files, so they are renamed when all are there."""
    spark, work = rows.sparkSession, f"{folder}-parts"
    rows.repartition(name).write.partitionBy(name).option("header", True).csv(work)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(folder)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(work)
    key = F.url_decode(F.regexp_extract("path", rf"/{name}=([^/]*)/", 1))
    for r in found.select("path", key.alias("name")).collect():
        store.rename(hadoop.Path(r["path"]), hadoop.Path(target, r["name"]))
    remove_folder(spark, work)
