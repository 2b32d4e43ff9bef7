"""Aggregates: guarded ratios, correlations, frequency tables, pivots, histograms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.operators.quantiles import average_ranks


_SUMS = ("n", "x", "y", "xx", "yy", "xy")
_FLAT = 1e-12    # a variance below this share of the sum of squares is rounding


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """Quotient; undefined gives ``default``."""
    value = F.try_divide(top, bottom)
    return value if default is None else F.coalesce(value, F.lit(default))


def avg_where(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def pearson(x: Column, y: Column, min_rows: int = 1) -> Column:
    """Correlation over rows with both values; NULL for constant columns or too few rows.

    The built-in raises on zero variance under ANSI mode, hence the guarded quotient.
    """
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    r = F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
    return F.when(F.count(xs) >= min_rows, r)


def correlation_pairs(df: DataFrame, columns: Sequence[str], min_rows: int = 31) -> DataFrame:
    """(left, right, r, n) for every pair of the named columns, from the ``n`` rows where both have a
    value; r is NULL below ``min_rows`` rows and for a constant column.

    Tasks add up the products of their batches as matrices, with a mask for the values that are there,
    and give one row per pair.  Values are taken from their column's mean first, so sums of squares
    do not swamp what they measure.
    """
    columns = list(columns)
    k = len(columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    centred = df.select(*[(F.col(c).cast("double") - F.lit(float(means[c] or 0.0))).alias(c) for c in columns])
    upper = np.triu_indices(k, 1)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, k, k))      # per pair: rows, x, y, xx, yy, xy
        for batch in batches:
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), np.float64) for c in batch.columns])
            there = ~np.isnan(x)
            x, mask = np.where(there, x, 0.0), there.astype(np.float64)
            sx, sxx = x.T @ mask, (x * x).T @ mask
            sums += np.stack([mask.T @ mask, sx, sx.T, sxx, sxx.T, x.T @ x])
        cells = [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *(pa.array(m[upper]) for m in sums)]
        yield pa.RecordBatch.from_arrays(cells, names=["i", "j", *_SUMS])

    parts = centred.mapInArrow(add_up, "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS))
    n, x, y, xx, yy, xy = (F.col(c) for c in _SUMS)
    some = F.nullif(n, F.lit(0.0))
    vx, vy = F.greatest(xx - x * x / some, F.lit(0.0)), F.greatest(yy - y * y / some, F.lit(0.0))
    varied = (vx > _FLAT * xx) & (vy > _FLAT * yy) & (n >= min_rows)
    names = F.array(*[F.lit(c) for c in columns])
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return total.select(
        F.get(names, F.col("i")).alias("left"), F.get(names, F.col("j")).alias("right"),
        F.when(varied, F.try_divide(xy - x * y / some, F.sqrt(vx * vy))).alias("r"), n.cast("long").alias("n"))


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope and intercept with r; NULL when x is constant."""
    varied = F.min(x) < F.max(x)
    return df.dropna(subset=[x, y]).groupBy(*by).agg(
        F.when(varied, F.try_divide(F.covar_pop(y, x), F.var_pop(x))).alias("slope"),
        F.when(
            varied, F.avg(y) - F.try_divide(F.covar_pop(y, x), F.var_pop(x)) * F.avg(x)
        ).alias("intercept"),
        pearson(F.col(x), F.col(y)).alias("r"),
        F.count("*").alias("n"),
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation, ties averaged; rows are first reduced to (x, y, count)."""
    pairs = df.dropna(subset=[x, y]).groupBy(x, y).agg(F.count("*").alias("w"))
    rx = average_ranks(pairs, x, "w").select(x, F.col("rank").alias("_rx"), "total")
    ry = average_ranks(pairs, y, "w").select(y, F.col("rank").alias("_ry"))
    joined = pairs.join(rx, x).join(ry, y)
    dx = F.col("_rx") - (F.col("total") + 1) / 2
    dy = F.col("_ry") - (F.col("total") + 1) / 2
    return joined.agg(
        F.try_divide(
            F.sum(F.col("w") * dx * dy), F.sqrt(F.sum(F.col("w") * dx * dx) * F.sum(F.col("w") * dy * dy))
        ).alias("rho"),
        F.sum("w").alias("n"),
    )


def sign_agreement(a: Column, b: Column) -> Column:
    """Share of rows where both values have the same sign."""
    return F.avg((F.signum(a) == F.signum(b)).cast("int"))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Frequency table with the share of the total."""
    counts = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def pivot_table(
    df: DataFrame, rows: str, columns: str, values: Sequence[str], agg: Column, fill: float | None = 0
) -> DataFrame:
    """Pivot with a fixed column list, absent cells filled."""
    wide = df.groupBy(rows).pivot(columns, list(values)).agg(agg)
    return wide if fill is None else wide.fillna(fill, list(values))


def row_shares(wide: DataFrame, values: Sequence[str], scale: float = 1.0) -> DataFrame:
    """Divide each pivot cell by its row total."""
    total = sum((F.col(v) for v in values), F.lit(0))
    keep = [c for c in wide.columns if c not in values]
    return wide.select(*keep, *[(F.try_divide(F.col(v), total) * scale).alias(v) for v in values])


def null_rates(df: DataFrame, columns: Sequence[str] | None = None, decimals: int = 1) -> DataFrame:
    """Percent missing per column, only columns with any, one scan."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return unpivot(one, columns, "column", "share").select(
        "column", F.bround(F.col("share") * 100, decimals).alias("missing_pct")
    ).where("missing_pct > 0")


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in columns])
    return unpivot(one, columns, "column", "completeness")


def nonzero_days(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c) > 0).alias(c) for c in columns])
    return unpivot(one, columns, "column", "days")


def unpivot(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([], list(columns), name, value)


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Counts and density over equal-width bins; the last bin holds its upper edge."""
    width = (high - low) / bins
    spot = F.least(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    inside = df.where(F.col(value).between(low, high)).withColumn("bin", spot.cast("int"))
    counts = inside.groupBy(*by, "bin").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(*by))   # at most `bins` rows per group
    return counts.withColumn("density", F.col("n") / (total * F.lit(width)))


def any_of(*flags: str) -> Column:
    """1 when any flag column is positive."""
    return F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in flags], F.lit(0)).cast("boolean").cast("int")


def mode_per_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Most frequent value per key, ties to the alphabetically first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))
