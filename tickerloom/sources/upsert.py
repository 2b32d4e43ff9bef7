"""Keyed merges of updates into a table, as plans that return the new table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.keyed import first_per_key


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str],
    overwrite: Sequence[str] | None = None, fill: Sequence[str] = (), newest: Sequence[Column] = (),
) -> DataFrame:
    """Merge ``updates`` into ``target``.

    On a key match, ``overwrite`` columns take the new value (default: all columns not in
    ``fill``), ``fill`` columns take it only when it is not NULL, the others keep the old one.
    New keys are inserted whole.  ``newest`` orders several updates of one key, best first;
    without it update keys must be unique.
    """
    keys = list(keys)
    if newest:
        updates = first_per_key(updates, keys, *newest)
    others = [c for c in target.columns if c not in keys]
    if overwrite is None:
        overwrite = [c for c in others if c not in fill]
    has = set(updates.columns)
    new = updates.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in others if c in has])
    joined = target.withColumn("_old", F.lit(True)).join(new, keys, "full_outer")

    def merged(c: str) -> Column:
        if c not in has:
            return F.col(c)
        fresh, old = F.col(f"_new_{c}"), F.col(c)
        if c in fill:
            return F.coalesce(fresh, old).alias(c)
        if c in overwrite:
            return F.when(F.col("_new"), fresh).otherwise(old).alias(c)
        return F.when(F.col("_old"), old).otherwise(fresh).alias(c)

    return joined.select(*[F.col(c) if c in keys else merged(c) for c in target.columns])


def insert_ignore(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows whose key is new; stored rows stay as they are."""
    fresh = updates.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def append_or_replace(stored: DataFrame, increment: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increment rows replace stored rows of the same key (the last one wins)."""
    both = stored.withColumn("_src", F.lit(0)).unionByName(increment.withColumn("_src", F.lit(1)))
    return first_per_key(both, list(keys), F.desc("_src")).drop("_src")
