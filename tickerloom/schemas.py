"""Declared schemas for stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from tickerloom.constants import EVENT_TYPES, ROLL_BASE, ROLL_WINDOWS, TYPE_FLAGS

S, I, L, D, DATE, TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType(),
)
SMALL, FLAG = T.ShortType(), T.BooleanType()
RATIO, MEAN = T.DecimalType(8, 5), T.DecimalType(8, 4)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


COMPANIES = table(
    ticker=S, company_name=S, sector=S, parent=S, description=S, ceo=S, founded=I,
    headquarters=S, revenue=S, employees=I, stock_exchange=S, siege_social=S,
)
PRICES = table(ticker=S, date=DATE, close=D, open=D, high=D, low=D, volume=D, change_pct=D)
PRICES_SCRAPED = table(ticker=S, libelle=S, cours=S, variation=S, scraped_at=DATE)
FEEDS = table(url=S, name=S, language=S)
ARTICLES = table(url=S, title=S, published_at=TS, full_text=S, language=S, feed_url=S)
SENTIMENT = table(article_url=S, sentiment=S, score=D, confidence=D, reasoning=S, analyzed_at=TS)
EVENTS = table(fingerprint=S, event_type=S, event_date=DATE, first_seen=TS, article_count=I)
PEOPLE = table(normalized_name=S, name=S, role=S)
COMMODITIES = table(
    asset_key=S, date=DATE, ticker=S, name=S, category=S, open=D, high=D, low=D, close=D,
    adj_close=D, volume=D,
)
FX_RATES = table(
    rate_date=DATE, currency=S, country=S, unit=I, buy_rate=T.DecimalType(12, 4),
    sell_rate=T.DecimalType(12, 4), scraped_at=TS,
)
CAPTURES = table(
    url=S, capture_timestamp=S, original_published_date=TS, raw_html_path=S, digest=S,
    status=I, mimetype=S, length=L,
)
RUNS = table(
    run_id=S, pipeline_name=S, dag_run_id=S, task_id=S, started_at=TS, ended_at=TS, status=S,
    error_message=S, rows_processed=I, rows_failed=I,
)
RUN_EVENTS = table(
    id=L, run_id=S, ts=TS, level=S, stage=S, message=S, item_key=S, metric_name=S, metric_value=D,
)
ANALYSIS = T.StructType([
    T.StructField("sentiment", S), T.StructField("score", D), T.StructField("confidence", D),
    T.StructField("reasoning", S),
    T.StructField("mentioned_tickers", T.ArrayType(S)),
    T.StructField("mentioned_sectors", T.ArrayType(S)),
    T.StructField("event_type", S), T.StructField("event_date", S),
    T.StructField("mentioned_people", T.ArrayType(table(name=S, role=S))),
])

_COUNTS = [
    "news_count", "positive_count", "negative_count", "event_ma", "event_earnings",
    "event_management", "event_legal", "negated_count", "speculative_count", *TYPE_FLAGS,
]


def _daily_signals() -> T.StructType:
    out = table(
        ticker=S, date=DATE, close=D, open=D, high=D, low=D, volume=D, change_pct=D,
        daily_return=D, next_day_return=D, direction=SMALL, has_news=FLAG,
        avg_sentiment=RATIO, std_sentiment=RATIO, positive_ratio=RATIO, negative_ratio=RATIO,
    )
    for name in _COUNTS:
        out.add(name, SMALL)
    shares = {"avg_sentiment", "std_sentiment", "positive_ratio", "negative_ratio"}
    for window in ROLL_WINDOWS:
        for name in [*ROLL_BASE, *TYPE_FLAGS]:
            out.add(f"{name}_r{window}d", RATIO if name in shares else MEAN)
    return out


def _period(key: str) -> T.StructType:
    out = table(ticker=S)
    out.add(key, DATE)
    for name in ROLL_BASE:
        out.add(name, I if name == "news_count" or name.startswith("event_") else RATIO)
    for name in TYPE_FLAGS:
        out.add(name, I)
    return out


# Gold tables, parents before children.
GOLD: dict[str, T.StructType] = {
    "company_dim": table(
        ticker=S, company_name=S, sector=S, ceo=S, founded=I, headquarters=S, revenue=S,
        employees=I, total_news_count=I, avg_sentiment_all_time=RATIO, top_event_type=S,
        first_article_date=DATE, last_article_date=DATE,
    ),
    "event_facts": EVENTS,
    "event_company_bridge": table(fingerprint=S, ticker=S),
    "daily_signals": _daily_signals(),
    "sentiment_weekly": _period("week_start"),
    "sentiment_monthly": _period("month_start"),
    "commodity_daily": table(
        asset_key=S, date=DATE, name=S, category=S, close=D, daily_return=D, close_r3d=D,
        close_r7d=D, return_r3d=D, return_r7d=D, volatility_r7d=D,
    ),
}

assert len(EVENT_TYPES) == 13
