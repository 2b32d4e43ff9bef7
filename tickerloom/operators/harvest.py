"""Run logs and page-capture indexes as table jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.constants import ARCHIVE_EXCLUDE
from tickerloom.operators.keyed import optional_equal, since
from tickerloom.operators.stats import ratio


def url_filter(url: Column, include: str | None = None, exclude: str | None = ARCHIVE_EXCLUDE) -> Column:
    keep = url.rlike(include) if include else F.lit(True)
    return keep & ~url.rlike(exclude) if exclude else keep


def capture_index(
    captures: DataFrame, include: str | None = None, exclude: str | None = ARCHIVE_EXCLUDE
) -> DataFrame:
    """Successful HTML captures that pass the URL filters, one per (url, stamp)."""
    good = (F.col("status") == 200) & (F.col("mimetype") == "text/html")
    return captures.where(good & url_filter(F.col("url"), include, exclude)).dropDuplicates(["url", "capture_timestamp"])


def _has_path() -> Column:
    return F.coalesce(F.col("raw_html_path"), F.lit("")) != ""


def _month() -> Column:
    stamp = F.col("capture_timestamp")
    captured = F.when(F.length(stamp) >= 6, F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2)))
    return F.coalesce(F.date_format("original_published_date", "yyyy-MM"), captured)


def _domain_measures() -> list[Column]:
    has_path = _has_path()
    dated = F.col("original_published_date").isNotNull()
    stamp = F.nullif(F.col("capture_timestamp"), F.lit(""))
    return [
        F.count("*").alias("indexed"), F.count_if(has_path).alias("fetched"),
        F.count_if(~has_path).alias("pending"),
        F.min(stamp).alias("oldest"), F.max(stamp).alias("newest"),
        F.count_if(has_path & dated).alias("with_date"), F.count_if(has_path & ~dated).alias("without_date"),
    ]


def domain_stats(captures: DataFrame, domain: str = "domain") -> DataFrame:
    return captures.groupBy(domain).agg(*_domain_measures())


def domain_totals(captures: DataFrame, domain: str = "domain") -> DataFrame:
    """Per-domain rows plus a TOTAL row, in one aggregation."""
    return captures.rollup(domain).agg(*_domain_measures(), F.grouping(domain).alias("_g")).withColumn(
        domain, F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col(domain))
    ).drop("_g")


def captures_by_month(captures: DataFrame, *by: str) -> DataFrame:
    """Publication month, else capture month."""
    return captures.withColumn("month", _month()).where("month IS NOT NULL").groupBy(*by, "month").agg(
        F.count("*").alias("n")
    )


def fetch_rate(fetches: DataFrame, ts: str, as_of: datetime | None = None, seconds: int = 3600) -> DataFrame:
    """Items per hour over the last ``seconds``."""
    now = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    age = F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp"))
    recent = fetches.agg(F.count_if(age <= seconds * 1_000_000).alias("recent"))
    return recent.select("recent", (F.col("recent") * (3600 / seconds)).alias("per_hour"))


def eta_hours(pending: Column, per_hour: Column) -> Column:
    return F.when(per_hour > 0, F.try_divide(pending, per_hour))


# --- run log -----------------------------------------------------------------------------

def recent_runs(runs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return since(runs, "started_at", as_of, days=1)


def run_kpis(runs: DataFrame) -> DataFrame:
    """Totals by status with the success rate over completed runs."""
    counts = runs.agg(
        F.count("*").alias("total_runs"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("running", "success", "failed")],
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("rows_processed"),
        F.coalesce(F.sum("rows_failed"), F.lit(0)).alias("rows_failed"),
    )
    done = F.col("success") + F.col("failed")
    return counts.withColumn("success_rate", ratio(F.col("success") * 100.0, done))


def run_trend(runs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Last seven days by day, name and status."""
    return since(runs, "started_at", as_of, days=7).groupBy(
        F.to_date("started_at").alias("day"), "pipeline_name", "status"
    ).agg(F.count("*").alias("runs"), F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("rows_processed"))


def recent_problems(events: DataFrame, as_of: datetime | None = None, limit: int | None = None) -> DataFrame:
    bad = events.where(F.col("level").isin("warning", "error"))
    newest = since(bad, "ts", as_of, days=1).orderBy(F.desc("ts"), F.desc("id"))
    return newest if limit is None else newest.limit(limit)


def run_list(runs: DataFrame, name: str | None = None, status: str | None = None, limit: int | None = None) -> DataFrame:
    """Matching runs, newest first; ``limit`` counts matching runs."""
    matching = optional_equal(optional_equal(runs, "pipeline_name", name), "status", status)
    newest = matching.orderBy(F.desc("started_at"), "run_id")
    return newest if limit is None else newest.limit(limit)


def run_detail(events: DataFrame, run_id: str) -> DataFrame:
    return events.where(F.col("run_id") == run_id)


def level_counts(events: DataFrame) -> DataFrame:
    """Counts per level with the fixed display order error, warning, info."""
    order = F.when(F.col("level") == "error", 1).when(F.col("level") == "warning", 2).when(F.col("level") == "info", 3)
    return events.where(order.isNotNull()).groupBy("level").agg(
        F.count("*").alias("n"), F.min(order).alias("position")
    )


def run_record(
    events: DataFrame, run_id: str = "run_id", name: str = "pipeline_name"
) -> DataFrame:
    """Run rows derived from their events: time span, status, processed and failed counts."""
    failed = F.count_if(F.col("level") == "error")
    return events.groupBy(run_id, name).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"),
        F.when(failed > F.count("*") / 4, "failed").otherwise("success").alias("status"),
        F.count("*").alias("rows_processed"), failed.alias("rows_failed"),
    )
