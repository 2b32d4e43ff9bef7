"""News features per ticker and day, price signals, periods, dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom import constants as K
from tickerloom.functions import text as TX
from tickerloom.functions.labels import one_hot
from tickerloom.operators.entities import containment_join
from tickerloom.operators.keyed import add_first_value, unknown_only
from tickerloom.operators.stats import mode_per_key, ratio


EXACT_SCORE = "decimal(20,9)"


def map_entities(
    articles: DataFrame, companies: DataFrame, mentions: DataFrame, body_chars: int | None = None
) -> DataFrame:
    """One row per (article, ticker): stored mentions, else company names found in the text.

    The whole body is searched; ``body_chars`` limits it on request.
    """
    linked = mentions.select(F.col("article_url").alias("url"), "ticker", F.lit(True).alias("_stored"))
    rest = unknown_only(articles, "url", mentions, "article_url")
    body = F.col("full_text") if body_chars is None else F.substring("full_text", 1, body_chars)
    words = TX.joined_text("title", body).alias("_text")
    found = containment_join(
        rest.select("url", words), "url", "_text", companies.select("ticker", "company_name"), "company_name", sample=articles.select(words))
    named = found.select("url", F.col("ticker").alias("_named"))
    # names are found only for articles without mentions, so each row takes its ticker from one side
    both = articles.join(linked, "url", "left").join(named, "url", "left").where("_stored OR _named IS NOT NULL") \
        .withColumn("ticker", F.when(F.col("_stored"), F.col("ticker")).otherwise(F.col("_named"))).drop("_stored", "_named")
    return both.withColumn("date", F.to_date("published_at"))


def enrich_articles(
    mapped: DataFrame, article_events: DataFrame, rules: TX.TextRules = TX.TextRules()
) -> DataFrame:
    """Event flags, lexicon fallback where no sentiment is stored, event-type one-hots."""
    words = TX.joined_text("title", "full_text")
    missing = F.col("sentiment").isNull()
    lex = F.when(missing, TX.lexicon_sentiment(words, rules))
    flagged = mapped.withColumns({**TX.event_flags(words, rules), "_lex": lex}).withColumns({
        "sentiment": F.when(missing, F.col("_lex.sentiment")).otherwise(F.col("sentiment")),
        "score": F.coalesce(F.when(missing, F.col("_lex.score")).otherwise(F.col("score")), F.lit(0.0)),
        "confidence": F.when(missing, F.col("_lex.confidence")).otherwise(F.col("confidence")),
        "sentiment_source": F.when(missing, "lexicon").otherwise("llm"),
    }).drop("_lex")
    typed = add_first_value(flagged, "url", article_events, "article_url", "event_type", "llm_event_type")
    return typed.select("*", *one_hot(F.col("llm_event_type"), rules.event_types, "llm_evt_"))


def daily_features(
    enriched: DataFrame, score: str = "score", type_columns: Sequence[str] = K.TYPE_FLAGS, parts: int | None = None
) -> DataFrame:
    """Per ticker and day: distinct articles, score mean and deviation, flag and type sums.

    Scores are summed in billionths, so the mean does not depend on the order of the rows and scores
    that cancel give exactly 0.  Rows are dealt by ticker, into ``parts`` parts where a number is given.
    """
    positive = (F.col("sentiment") == "positive").cast("int")
    negative = (F.col("sentiment") == "negative").cast("int")
    sums: dict[str, Column | str] = {
        "positive_count": positive, "negative_count": negative,
        "event_ma": "event_ma", "event_earnings": "event_earnings",
        "event_management": "event_management", "event_legal": "event_legal",
        "negated_count": "is_negated", "speculative_count": "is_speculative",
        **{c: c for c in type_columns},
    }
    # one deal by ticker, which the windows over days need too: rows of the fewest columns move once
    rows = enriched.dropna(subset=["ticker", "date"]).select(
        "ticker", "date", "url", F.col(score).alias("_score"),
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in sums.items()],
    ).repartition(*(() if parts is None else (parts,)), "ticker")
    before = F.lag("url").over(W.partitionBy("ticker", "date").orderBy("url"))
    rows = rows.withColumn("_new", F.col("url").isNotNull() & ~F.col("url").eqNullSafe(before))
    daily = rows.groupBy("ticker", "date").agg(
        F.count_if("_new").alias("news_count"),
        (F.sum(F.col("_score").cast(EXACT_SCORE)).cast("double") / F.nullif(F.count("_score"), F.lit(0))).alias("avg_sentiment"),
        F.coalesce(F.stddev_samp("_score"), F.lit(0.0)).alias("std_sentiment"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
    )
    return daily.withColumns({
        "positive_ratio": ratio(F.col("positive_count"), F.col("news_count")),
        "negative_ratio": ratio(F.col("negative_count"), F.col("news_count")),
    })


def rolling_mean(
    df: DataFrame, key: str, order: str, columns: Sequence[str], windows: Sequence[int] = K.ROLL_WINDOWS
) -> DataFrame:
    """Trailing means over the last w rows of a key: one exchange, one sort.

    The rows before are fetched whole, one offset each; a sliding frame would add every value up anew
    for each row and column.  Values are added oldest first, as an average over the frame adds them.
    """
    columns = list(columns)
    w = W.partitionBy(key).orderBy(order)
    names = [f"_back{i}" for i in range(1, max(windows))]
    back = df.select("*", *[F.lag(F.struct(*columns), i).over(w).alias(name) for i, name in enumerate(names, 1)])

    def mean(column: str, rows: int) -> Column:
        values = [*(F.col(f"{name}.{column}") for name in reversed(names[:rows - 1])), F.col(column)]
        total, count = F.lit(0.0), F.lit(0)
        for value in values:
            total, count = total + F.coalesce(value.cast("double"), F.lit(0.0)), count + value.isNotNull().cast("int")
        return F.try_divide(total, count)

    return back.select(*df.columns, *[mean(c, n).alias(f"{c}_r{n}d") for n in windows for c in columns])


def build_features(enriched: DataFrame, type_columns: Sequence[str] = K.TYPE_FLAGS) -> DataFrame:
    return rolled_features(daily_features(enriched, type_columns=type_columns), type_columns)


def rolled_features(daily: DataFrame, type_columns: Sequence[str] = K.TYPE_FLAGS) -> DataFrame:
    """Daily features with their trailing means."""
    return rolling_mean(daily, "ticker", "date", [*K.ROLL_BASE, *type_columns])


def add_returns(
    prices: DataFrame, key: str = "ticker", order: str = "date", close: str = "close",
    drop_unlabelled: bool = False,
) -> DataFrame:
    """daily_return, next_day_return and direction (0 on the last row unless dropped).

    A zero base gives NULL.
    """
    w = W.partitionBy(key).orderBy(order)
    # next return = next close / close - 1, so both need only one window pass
    change = F.try_divide(F.col(close), F.lag(close).over(w)) - 1
    ahead = F.try_divide(F.lead(close).over(w), F.col(close)) - 1
    out = prices.select("*", change.alias("daily_return"), ahead.alias("next_day_return")).withColumn(
        "direction", F.coalesce(F.col("next_day_return") > 0, F.lit(False)).cast("int")
    )
    return out.dropna(subset=["next_day_return"]) if drop_unlabelled else out


def build_daily_signals(features: DataFrame, prices: DataFrame, drop_unlabelled: bool = False) -> DataFrame:
    """All trading days with their news features, zero-filled on days without news."""
    names = [c for c in features.columns if c not in ("ticker", "date")]
    joined = add_returns(prices, drop_unlabelled=drop_unlabelled).join(features, ["ticker", "date"], "left")
    return joined.fillna(0, names).withColumn("has_news", F.col("news_count") != 0)


def company_stats(enriched: DataFrame) -> DataFrame:
    return enriched.dropna(subset=["ticker"]).groupBy("ticker").agg(
        F.countDistinct("url").alias("total_news_count"),
        F.avg("score").alias("avg_sentiment_all_time"),
        F.min("date").alias("first_article_date"),
        F.max("date").alias("last_article_date"),
    )


def build_company_dim(companies: DataFrame, enriched: DataFrame) -> DataFrame:
    top = mode_per_key(enriched, "ticker", "llm_event_type", "top_event_type")
    return (
        companies.join(company_stats(enriched), "ticker", "left").join(top, "ticker", "left")
        .fillna(0, ["total_news_count"])
    )


def week_label(day: Column) -> Column:
    """Closing Monday of the Tuesday-to-Monday week."""
    return F.next_day(F.date_sub(day, 1), "MON")


def month_label(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def resample(
    df: DataFrame, key: str, label: Column, step: str, out: str, sums: Sequence[str], means: Sequence[str]
) -> DataFrame:
    """Aggregate to periods and emit empty periods between a key's first and last one.

    Each period row stretches to the day before the next one, so gaps need no second join.
    """
    grouped = df.groupBy(key, label.alias(out)).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means]
    )
    span = F.expr(f"INTERVAL {step}")
    nxt = F.lead(out).over(W.partitionBy(key).orderBy(out))
    wide = grouped.withColumn("_last", F.coalesce(F.to_date(nxt - span), F.col(out))).withColumn(
        "_period", F.explode(F.sequence(F.col(out), F.col("_last"), span))
    )
    empty = F.col("_period") != F.col(out)
    return wide.select(
        key, F.col("_period").alias(out),
        *[F.when(empty, 0).otherwise(F.col(c)).alias(c) for c in sums],
        *[F.when(~empty, F.col(c)).alias(c) for c in means],
    )


PERIOD_MEANS = ["avg_sentiment", "std_sentiment", "positive_ratio", "negative_ratio"]
PERIOD_SUMS = ["news_count", "event_ma", "event_earnings", "event_management", "event_legal"]


def weekly(features: DataFrame, type_columns: Sequence[str] = K.TYPE_FLAGS) -> DataFrame:
    return resample(
        features, "ticker", week_label(F.col("date")), "7 days", "week_start",
        [*PERIOD_SUMS, *type_columns], PERIOD_MEANS,
    )


def monthly(features: DataFrame, type_columns: Sequence[str] = K.TYPE_FLAGS) -> DataFrame:
    return resample(
        features, "ticker", month_label(F.col("date")), "1 month", "month_start",
        [*PERIOD_SUMS, *type_columns], PERIOD_MEANS,
    )


def commodity_features(commodities: DataFrame) -> DataFrame:
    """Returns, 3/7-row means of price and return, 7-row volatility per asset."""
    w = W.partitionBy("asset_key").orderBy("date")
    with_return = commodities.withColumn("daily_return", F.try_divide(F.col("close"), F.lag("close").over(w)) - 1)
    return with_return.select(
        "asset_key", "date", "name", "category", "close", "daily_return",
        *[F.avg("close").over(w.rowsBetween(1 - n, 0)).alias(f"close_r{n}d") for n in K.ROLL_WINDOWS],
        *[F.avg("daily_return").over(w.rowsBetween(1 - n, 0)).alias(f"return_r{n}d") for n in K.ROLL_WINDOWS],
        F.stddev_samp("daily_return").over(w.rowsBetween(-6, 0)).alias("volatility_r7d"),
    )


def event_tables(events_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split (event, company) rows into event facts and the distinct bridge."""
    facts = events_raw.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(
        *[F.min(c).alias(c) for c in ("event_type", "event_date", "first_seen", "article_count")]
    )
    bridge = events_raw.select("fingerprint", "ticker").dropna().distinct()
    return facts, bridge


def carry_forward(prices: DataFrame, key: str, order: str, levels: Sequence[str], flows: Sequence[str]) -> DataFrame:
    """Missing-data policy: levels keep their last known value, flows become 0."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(w) for c in levels}
    filled.update({c: F.coalesce(F.col(c), F.lit(0.0)) for c in flows})
    return prices.withColumns(filled)


def min_history(df: DataFrame, key: str, rows: int = 60) -> DataFrame:
    """Keys with at least ``rows`` rows (counted by aggregation, kept by a semi join)."""
    enough = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= rows)
    return df.join(enough.select(key), key, "left_semi")
