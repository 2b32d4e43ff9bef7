"""The gold refresh as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.constants import TYPE_FLAGS
from tickerloom.functions.text import TextRules
from tickerloom.operators import daily as D
from tickerloom.session import tuned
from tickerloom.sources.sinks import full_refresh
from tickerloom.sources.silver import event_extract


def enriched_rows(
    articles: DataFrame, companies: DataFrame, mentions: DataFrame, article_events: DataFrame,
    rules: TextRules = TextRules(), body_chars: int | None = None,
) -> DataFrame:
    """One row per (article, ticker); text rules run once per article, before it is mapped."""
    return D.map_entities(D.enrich_articles(articles, article_events, rules), companies, mentions, body_chars)


def gold_frames(
    articles: DataFrame, companies: DataFrame, mentions: DataFrame, article_events: DataFrame,
    prices: DataFrame, events: DataFrame, event_companies: DataFrame, commodities: DataFrame,
    rules: TextRules = TextRules(), body_chars: int | None = None,
) -> dict[str, DataFrame]:
    """All seven gold tables.  Nothing runs until a sink asks."""
    enriched = enriched_rows(articles, companies, mentions, article_events, rules, body_chars)
    features = D.build_features(enriched)
    facts, bridge = D.event_tables(event_extract(events, event_companies))
    return {
        "company_dim": D.build_company_dim(companies, enriched),
        "event_facts": facts,
        "event_company_bridge": bridge,
        "daily_signals": D.build_daily_signals(features, prices),
        "sentiment_weekly": D.weekly(features, TYPE_FLAGS),
        "sentiment_monthly": D.monthly(features, TYPE_FLAGS),
        "commodity_daily": D.commodity_features(commodities),
    }


def refresh_gold(folder: str, work: str, **silver: DataFrame) -> list[str]:
    """Compute and write the gold tables.

    Enriched rows feed the features and the company dimension; they are written to the shared work folder
    once and read back, so a lost executor costs a re-read instead of the whole text pass.  Daily features
    feed three tables: they are kept where they were dealt by ticker, so none of the three deals them again, in ``parts``
    parts where a number is given, that of the prices.
    """
    spark = tuned(silver["articles"].sparkSession)
    rules, body_chars = silver.pop("rules", TextRules()), silver.pop("body_chars", None)
    parts = silver.pop("parts", None) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text_inputs = [silver[n] for n in ("articles", "companies", "mentions", "article_events")]
    needed = ["url", "ticker", "date", "sentiment", "score", "llm_event_type", "event_ma", "event_earnings",
              "event_management", "event_legal", "is_negated", "is_speculative", *TYPE_FLAGS]
    enriched_rows(*text_inputs, rules, body_chars).select(*needed).write.mode("overwrite").parquet(f"{work}/enriched")
    enriched = spark.read.parquet(f"{work}/enriched")
    daily = D.daily_features(enriched, parts=parts).persist()
    facts, bridge = D.event_tables(event_extract(silver["events"], silver["event_companies"]))
    try:
        return full_refresh({
            "company_dim": D.build_company_dim(silver["companies"], enriched),
            "event_facts": facts,
            "event_company_bridge": bridge,
            "daily_signals": D.build_daily_signals(D.rolled_features(daily), silver["prices"]),
            "sentiment_weekly": D.weekly(daily),
            "sentiment_monthly": D.monthly(daily),
            "commodity_daily": D.commodity_features(silver["commodities"]),
        }, folder)
    finally:
        daily.unpersist()
