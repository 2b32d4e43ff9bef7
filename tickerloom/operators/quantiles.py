"""Exact order statistics without a single-task sort.

Values are first reduced to (value, count), so a value held by a third of all rows is one row.  A sample
sort follows: ranges of values, split by a sample, as many as the number of distinct values asks for;
ranks are running counts inside a range plus what the ranges before it hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.session import stored

ROWS_PER_RANGE = 1_000_000   # distinct values of one task


def ranked_values(df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Columns ``by``, value, ``n`` (rows), ``before`` (rows below), ``total`` (rows of the group).

    NULL values and NULL group keys are left out.  A group may span any number of ranges.
    """
    by = list(by)
    rows = F.count("*") if weight is None else F.sum(weight)
    counts = stored(df.dropna(subset=[value, *by]).groupBy(*by, value).agg(rows.alias("n")), "counts")
    ranges = -(-counts.count() // ROWS_PER_RANGE)
    if ranges > 1:
        # stored, since a second sample could split elsewhere
        placed = stored(counts.repartitionByRange(ranges, *by, value).withColumn("_range", F.spark_partition_id()), "ranges")
    else:
        placed = counts.withColumn("_range", F.lit(0))
    # a row per group and range that it touches
    ahead = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy(*by, "_range").agg(F.sum("n").alias("_size")).select(
        *by, "_range", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"),
        F.sum("_size").over(W.partitionBy(*by)).alias("total"),
    )
    inside = W.partitionBy(*by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, [*by, "_range"])
        .select(*by, value, "n", (F.col("_offset") + F.col("_below")).alias("before"), "total")
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Linear-interpolation quantiles, one column per entry of ``probs``."""
    ranks = ranked_values(df, value, by, weight)

    def at(rank: Column) -> Column:
        holds = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
        return F.max(F.when(holds, F.col(value).cast("double")))

    aggs, outs = [], []
    for name, p in probs.items():
        exact = F.col("total").cast("double") * F.lit(p) - F.lit(p)
        low = F.floor(exact)
        aggs += [
            at(low).alias(f"_{name}_lo"), at(F.ceil(exact)).alias(f"_{name}_hi"),
            F.max(exact - low).alias(f"_{name}_f"),
        ]
        lo, hi, frac = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_f")
        outs.append((lo + (hi - lo) * frac).alias(name))
    return ranks.groupBy(*by).agg(*aggs).select(*by, *outs)


def average_ranks(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Rank of each distinct value, ties averaged."""
    ranks = ranked_values(df, value, weight=weight)
    return ranks.select(value, (F.col("before") + (F.col("n") + 1) / 2).alias("rank"), "total")


def trim_between_quantiles(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Keep rows inside [q(low), q(high)], bounds included."""
    bounds = exact_quantiles(df, value, {"lo": low, "hi": high})
    pair = bounds.select(F.struct("lo", "hi")).scalar()
    return (
        df.withColumn("_b", pair)
        .where(F.col(value).between(F.col("_b.lo"), F.col("_b.hi"))).drop("_b")
    )


def quantile_bucket(df: DataFrame, value: str, q: int = 10, out: str = "bucket") -> DataFrame:
    """Equal-frequency buckets: right-closed, lowest included, duplicate edges dropped."""
    cuts = exact_quantiles(df, value, {f"q{i}": i / q for i in range(q + 1)})
    edges = cuts.select(F.array_distinct(F.array(*[f"q{i}" for i in range(q + 1)]))).scalar()
    inner = F.slice(F.col("_edges"), F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
    place = F.size(F.filter(inner, lambda e: e < F.col(value)))
    return df.withColumn("_edges", edges).withColumn(out, F.when(F.col(value).isNotNull(), place)).drop("_edges")


def describe_by(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per group."""
    basic = df.dropna(subset=list(by)).groupBy(*by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    quarters = exact_quantiles(df, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by)
    return basic.join(quarters, list(by), "left")
