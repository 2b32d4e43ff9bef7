"""Silver extracts: projections and joins that feed the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def article_extract(articles: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Dated articles with their stored sentiment, if any."""
    scores = sentiment.select(F.col("article_url").alias("url"), "sentiment", "score", "confidence")
    return articles.where(F.col("published_at").isNotNull()).join(scores, "url", "left")


def article_event_extract(article_events: DataFrame, events: DataFrame) -> DataFrame:
    types = events.where(F.col("event_type").isNotNull()).select("fingerprint", "event_type")
    return (
        article_events.withColumnRenamed("event_fingerprint", "fingerprint").select("article_url", "fingerprint")
        .join(types, "fingerprint").select("article_url", "event_type")
    )


def event_extract(events: DataFrame, event_companies: DataFrame) -> DataFrame:
    """One row per (event, company); events without companies keep a NULL ticker."""
    bridge = event_companies.select(F.col("event_fingerprint").alias("fingerprint"), "ticker")
    return events.join(bridge, "fingerprint", "left").select(
        "fingerprint", "event_type", "event_date", "first_seen", "article_count", "ticker"
    )


def scored_events(article_events: DataFrame, events: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Analyses with their events: one row per (article, event), not per article."""
    return (
        article_events.select("article_url", F.col("event_fingerprint").alias("fingerprint"))
        .join(events.select("fingerprint", "event_type"), "fingerprint")
        .join(sentiment.select("article_url", "sentiment", "score", "confidence"), "article_url")
    )


def one_per_article(scored: DataFrame) -> DataFrame:
    """Variant of `scored_events` without fan-out: the alphabetically first event type."""
    return scored.groupBy("article_url").agg(
        *[F.min(c).alias(c) for c in ("sentiment", "score", "confidence")],
        F.min(F.struct("event_type", "fingerprint")).alias("_e"),
    ).select("article_url", "sentiment", "score", "confidence", "_e.event_type", "_e.fingerprint")
