"""Row selection by key: latest row, first per key, semi/anti filters, look-back windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def _list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per_key(df: DataFrame, keys: Keys, *order: Column) -> DataFrame:
    """One row per key, first in ``order``.

    ``row_number = 1`` is planned with a per-task group limit before the shuffle, so a hot key
    sends one row per task, not its whole group.
    """
    pos = F.row_number().over(W.partitionBy(*_list(keys)).orderBy(*order))
    return df.withColumn("_pos", pos).where("_pos = 1").drop("_pos")


def latest_per_key(df: DataFrame, keys: Keys, ts: str, *ties: Column) -> DataFrame:
    return first_per_key(df, keys, F.desc_nulls_last(ts), *ties)


def top_per_key(df: DataFrame, keys: Keys, n: int, *order: Column) -> DataFrame:
    pos = F.row_number().over(W.partitionBy(*_list(keys)).orderBy(*order))
    return df.withColumn("rank", pos).where(F.col("rank") <= n)


def known_only(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key guard: rows whose key exists in the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.join(keys, column, "left_semi")


def unknown_only(df: DataFrame, column: str, stored: DataFrame, stored_column: str) -> DataFrame:
    """Resumable skip: rows whose key is not stored yet."""
    return df.join(stored.select(F.col(stored_column).alias(column)), column, "left_anti")


def add_first_value(
    df: DataFrame, column: str, source: DataFrame, source_key: str, value: str, out: str
) -> DataFrame:
    """Map join: the smallest value per key (an explicit choice for an unordered "first")."""
    one = source.groupBy(F.col(source_key).alias(column)).agg(F.min(value).alias(out))
    return df.join(one, column, "left")


def since_last_date(df: DataFrame, days: int, column: str = "date", anchor: DataFrame | None = None) -> DataFrame:
    """Rows at most ``days`` before the greatest date of ``anchor`` (default: the frame itself).

    The bound is a scalar subquery, evaluated once and pushed into the scan at run time.
    """
    last = (anchor if anchor is not None else df).agg(F.max(column)).scalar()
    return df.where(F.col(column) >= F.date_sub(F.to_date(last), days))


def since(df: DataFrame, column: str, as_of: date | datetime | None = None, **span: int) -> DataFrame:
    """Rows not older than ``span`` (days=, hours=) before ``as_of`` (default: now)."""
    now = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    age = F.make_interval(days=F.lit(span.get("days", 0)), hours=F.lit(span.get("hours", 0)))
    return df.where(F.col(column) >= now - age)


def within_span(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose value lies between the other column's minimum and maximum, both included."""
    span = other.agg(F.struct(F.min(other_column).alias("low"), F.max(other_column).alias("high"))).scalar()
    return df.where(F.col(column).between(span["low"], span["high"]))


def optional_equal(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Equality filter that "All" or None switches off."""
    return df if value in (None, "All") else df.where(F.col(column) == value)


def best_capture(captures: DataFrame) -> DataFrame:
    """Per URL: dated captures first, then the latest stamp; ties by digest."""
    return first_per_key(
        captures.where((F.col("status") == 200) & (F.coalesce("raw_html_path", F.lit("")) != "")),
        "url",
        F.col("original_published_date").isNotNull().desc(),
        F.desc_nulls_last("capture_timestamp"),
        F.asc_nulls_last("digest"),
    )


def dedup_by_source_order(df: DataFrame, key: str, source_rank: str, position: str) -> DataFrame:
    """Cross-source dedup: the first source wins, then the first position inside it."""
    return first_per_key(df, key, F.asc(source_rank), F.asc(position))


def fits(df: DataFrame, rows: int) -> bool:
    """Size check for a broadcast: at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows
