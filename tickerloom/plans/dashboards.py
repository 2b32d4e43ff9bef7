"""Report queries over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.constants import EVENT_TYPES
from tickerloom.operators.paging import PAGE_ITEMS, listed, paged_list
from tickerloom.operators.keyed import latest_per_key, optional_equal, since_last_date
from tickerloom.operators.quantiles import trim_between_quantiles
from tickerloom.operators.stats import avg_where, linear_fit, pearson, pivot_table, row_shares
from tickerloom.session import stored

# Types compared on the impact page (all but "other").
IMPACT_TYPES = [t for t in EVENT_TYPES if t != "other"]


def ticker_daily(signals: DataFrame, ticker: str, days: int = 365) -> DataFrame:
    recent = since_last_date(signals.where(F.col("ticker") == ticker), days, anchor=signals)
    return recent.orderBy("date")


def ticker_periods(periods: DataFrame, ticker: str, label: str) -> DataFrame:
    return periods.where(F.col("ticker") == ticker).orderBy(label)


def market_latest(signals: DataFrame, companies: DataFrame) -> DataFrame:
    """Newest row per ticker with its profile."""
    fields = [
        "ticker", "date", "close", "change_pct", "daily_return", "volume", "news_count",
        "avg_sentiment", "avg_sentiment_r7d", "positive_ratio", "negative_ratio",
    ]
    newest = latest_per_key(signals.select(*fields), "ticker", "date")
    return newest.join(companies.select("ticker", "company_name", "sector"), "ticker")


def movers(latest: DataFrame, n: int = 10, losers: bool = False) -> DataFrame:
    order = F.asc("change_pct") if losers else F.desc("change_pct")
    return latest.where(F.col("change_pct").isNotNull()).orderBy(order, "ticker").limit(n)


def headline_kpis(companies: DataFrame, latest: DataFrame, news: DataFrame) -> DataFrame:
    """Companies, sectors, mean 7-row sentiment, share advancing, articles."""
    dims = companies.agg(
        F.countDistinct("ticker").alias("companies"), F.countDistinct("sector").alias("sectors")
    )
    market = latest.agg(
        F.avg("avg_sentiment_r7d").alias("market_sentiment"),
        (F.avg(F.coalesce(F.col("change_pct") > 0, F.lit(False)).cast("int")) * 100).alias("advancing_pct"),
    )
    flow = news.agg(F.coalesce(F.sum("news_count"), F.lit(0)).alias("articles"))
    return dims.select(
        "*", market.select("market_sentiment").scalar().alias("market_sentiment"),
        market.select("advancing_pct").scalar().alias("advancing_pct"), flow.scalar().alias("articles"),
    )


def news_flow(signals: DataFrame, days: int = 90) -> DataFrame:
    """Articles and mean non-zero sentiment per day."""
    return since_last_date(signals, days).where("has_news").groupBy("date").agg(
        F.sum("news_count").alias("news_count"),
        F.avg(F.nullif(F.col("avg_sentiment"), F.lit(0.0))).alias("avg_sentiment"),
    )


def sector_sentiment(signals: DataFrame, companies: DataFrame, days: int = 90) -> DataFrame:
    sectors = companies.where(F.col("sector").isNotNull()).select("ticker", "sector")
    recent = since_last_date(signals, days).where("has_news").select("ticker", "avg_sentiment", "news_count")
    return recent.join(sectors, "ticker").groupBy("sector").agg(
        F.avg("avg_sentiment").alias("avg_sentiment"), F.sum("news_count").alias("news_count"),
        F.countDistinct("ticker").alias("companies"),
    ).orderBy(F.desc_nulls_last("news_count"), "sector")


def sentiment_return_pairs(signals: DataFrame, companies: DataFrame, days: int = 365) -> DataFrame:
    recent = since_last_date(signals, days).where("has_news AND avg_sentiment IS NOT NULL")
    return recent.select("ticker", "date", "avg_sentiment", "news_count", "daily_return", "next_day_return").join(
        companies.select("ticker", "sector"), "ticker"
    )


def sentiment_trend_line(pairs: DataFrame) -> DataFrame:
    """Regression of next-day return on sentiment after the 1 %/99 % trim.

    The pairs are stored: the quantiles and the fit read them several times.
    """
    usable = stored(pairs.dropna(subset=["next_day_return"]).select("avg_sentiment", "next_day_return"), "pairs")
    return linear_fit(trim_between_quantiles(usable, "next_day_return"), "avg_sentiment", "next_day_return")


def lead_lag(pairs: DataFrame, min_days: int = 10) -> DataFrame:
    """Per ticker: correlation of sentiment with same-day and next-day return, NULL below ``min_days``."""
    s, same, nxt = F.col("avg_sentiment"), F.col("daily_return"), F.col("next_day_return")
    return pairs.groupBy("ticker").agg(
        F.min("sector").alias("sector"),
        F.count(nxt).alias("news_days"),
        pearson(s, same, min_days).alias("corr_same_day"),
        pearson(s, nxt, min_days).alias("corr_next_day"),
    )


def event_impact(signals: DataFrame, types: Sequence[str] = IMPACT_TYPES) -> DataFrame:
    """Mean next-day return on days with and without each event type, one scan."""
    r = F.col("next_day_return")
    aggs = []
    for t in types:
        flag = F.col(f"llm_evt_{t}")
        aggs += [
            avg_where(r, flag > 0).alias(f"{t}__present"),
            avg_where(r, (flag == 0) | flag.isNull()).alias(f"{t}__absent"),
            F.count_if(flag > 0).alias(f"{t}__n"),
        ]
    one = signals.where(r.isNotNull()).agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(t).alias("event_type"), F.col(f"{t}__n").alias("n_days"),
            F.col(f"{t}__present").alias("present"), F.col(f"{t}__absent").alias("absent"),
        )
        for t in types
    ])
    table = one.select(F.inline(rows)).where("n_days > 0 AND present IS NOT NULL")
    return table.withColumn("lift", F.col("present") - F.coalesce("absent", F.lit(0.0)))


def event_list(facts: DataFrame, bridge: DataFrame, limit: int, event_type: str | None = None) -> DataFrame:
    """The newest ``limit`` dated events with their sorted tickers as text.

    The events are chosen first; only their tickers are listed."""
    dated = optional_equal(facts.where(F.col("event_date").isNotNull()), "event_type", event_type)
    order = [F.desc("event_date"), F.asc("fingerprint")]
    chosen = dated.orderBy(*order).limit(limit)
    own = bridge.join(F.broadcast(chosen.select("fingerprint")), "fingerprint", "left_semi")
    names = listed(paged_list(own, "fingerprint", "ticker"), "fingerprint").withColumnRenamed("text", "tickers")
    return chosen.join(names, "fingerprint", "left").orderBy(*order)


def event_ticker_pages(facts: DataFrame, bridge: DataFrame, size: int = PAGE_ITEMS) -> DataFrame:
    """All events beside the pages of their ticker lists; an event without tickers has one empty page."""
    pages = paged_list(bridge, "fingerprint", "ticker", size).select("fingerprint", "page", F.col("items").alias("tickers"))
    return facts.join(pages, "fingerprint", "left").fillna(0, ["page"]).withColumn(
        "tickers", F.coalesce("tickers", F.array().cast("array<string>")))


def events_over_time(facts: DataFrame, freq: str = "month") -> DataFrame:
    period = F.to_date(F.date_trunc(freq, "event_date"))
    return facts.where(F.col("event_date").isNotNull()).groupBy(period.alias("period"), "event_type").agg(
        F.count("*").alias("n")
    )


def events_over_time_wide(facts: DataFrame, freq: str = "month", types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    return pivot_table(events_over_time(facts, freq), "period", "event_type", types, F.sum("n"))


def most_active(bridge: DataFrame, companies: DataFrame, limit: int = 15) -> DataFrame:
    """Counts are formed per ticker before the profile is joined."""
    counts = bridge.groupBy("ticker").agg(F.countDistinct("fingerprint").alias("event_count"))
    profile = companies.select("ticker", "company_name", "sector")
    return counts.join(profile, "ticker").orderBy(F.desc("event_count"), "ticker").limit(limit)


def ticker_events(facts: DataFrame, bridge: DataFrame, ticker: str) -> DataFrame:
    own = bridge.where(F.col("ticker") == ticker).select("fingerprint").distinct()
    dated = facts.where(F.col("event_date").isNotNull())
    return dated.join(own, "fingerprint").select("event_type", "event_date", "article_count").orderBy("event_date")


def commodity_snapshot(commodity_daily: DataFrame) -> DataFrame:
    fields = ["asset_key", "name", "category", "date", "close", "daily_return", "return_r7d", "volatility_r7d"]
    return latest_per_key(commodity_daily.select(*fields), "asset_key", "date")


def commodity_history(commodity_daily: DataFrame, asset_key: str, days: int = 180) -> DataFrame:
    own = commodity_daily.where(F.col("asset_key") == asset_key)
    return since_last_date(own, days, anchor=commodity_daily).select("date", "close", "daily_return").orderBy("date")


def sector_event_matrix(facts: DataFrame, bridge: DataFrame, companies: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Distinct dated events per sector and type.  The bridge holds a row per event and ticker, so
    sectors are joined to it and made distinct before the events are."""
    sectors = companies.select("ticker", "sector").dropna(subset=["sector"])
    placed = bridge.join(sectors, "ticker").select("fingerprint", "sector").distinct()
    dated = facts.where(F.col("event_date").isNotNull() & F.col("event_type").isNotNull()).select("fingerprint", "event_type")
    counts = placed.join(dated, "fingerprint").groupBy("sector", "event_type").agg(F.countDistinct("fingerprint").alias("n"))
    return pivot_table(counts, "sector", "event_type", types, F.sum("n"))


def source_mix(articles: DataFrame, feeds: DataFrame) -> DataFrame:
    """Articles per source and stored sentiment (unscored ones have a NULL label)."""
    counts = articles.groupBy("feed_url", "sentiment").agg(F.count("*").alias("n"))
    return counts.join(feeds.select(F.col("url").alias("feed_url"), F.col("name").alias("source")), "feed_url").select(
        "source", "sentiment", "n"
    )


def feed_mix(articles: DataFrame, feed: str, top: int = 8, labels: Sequence[str] = ("positive", "neutral", "negative")) -> DataFrame:
    """Percent of each sentiment within the biggest feeds."""
    counts = articles.where(F.col(feed).isNotNull()).groupBy(feed, "sentiment").agg(F.count("*").alias("n"))
    best = counts.groupBy(feed).agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), feed).limit(top)
    wide = pivot_table(counts.join(best.select(feed), feed, "left_semi"), feed, "sentiment", labels, F.sum("n"))
    return row_shares(wide, labels, 100.0)


def monthly_sentiment(articles: DataFrame) -> DataFrame:
    month = F.date_format("published_at", "yyyy-MM")
    return articles.where(F.col("score").isNotNull()).groupBy(month.alias("month")).agg(F.avg("score").alias("avg_score"))


def monthly_articles(articles: DataFrame) -> DataFrame:
    """Articles per month, labelled by month end, months without articles count 0."""
    counts = articles.groupBy(F.last_day(F.to_date("published_at")).alias("month_end")).agg(F.count("*").alias("n"))
    span = counts.agg(F.struct(F.min("month_end").alias("low"), F.max("month_end").alias("high"))).scalar()
    first, last = F.trunc(span["low"], "MM"), F.trunc(span["high"], "MM")
    calendar = articles.sparkSession.range(1).select(
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("m")
    ).select(F.last_day("m").alias("month_end"))
    return calendar.join(counts, "month_end", "left").fillna(0, ["n"])
