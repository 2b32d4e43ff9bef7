"""Registered queries: gold tables, aggregates, windows."""

from __future__ import annotations


from pyspark.sql import functions as F

from tickerloom.constants import EVENT_TYPES, ROLL_BASE, TYPE_FLAGS
from tickerloom.functions import labels as LB
from tickerloom.functions.text import TextRules
from tickerloom.operators import daily as D
from tickerloom.operators import graph as G
from tickerloom.operators import keyed as KY
from tickerloom.operators import market as MK
from tickerloom.operators import quantiles as Q
from tickerloom.operators.paging import paged_list
from tickerloom.operators import stats as ST
from tickerloom.plans.catalog import query
from tickerloom.plans.check_views import FEATURE_COLUMNS, ROLLED
from tickerloom.plans.catalog_tables import BRANDS, PAGE, paged_sql
from tickerloom.sources.warehouse import PROSE_RULES

DAILY_DOUBLES = "avg_sentiment std_sentiment positive_ratio negative_ratio"
PRICE_DOUBLES = "open high low close change_pct daily_return next_day_return"

# --- the gold tables ---------------------------------------------------------------------

# Unicode word boundaries spelled out for an engine whose \b is ASCII.
_NW = r"[^\p{L}\p{M}\p{N}_]"


def _word(*words: str) -> str:
    return "CAST(" + " OR ".join(
        rf"regexp_matches(lower(t), '(^|{_NW}){x}($|{_NW})')" for x in words
    ) + " AS INTEGER)"


_GAP = r"[^\p{L}\p{M}\p{N}_\n]"
PROSE_FLAGS = f"""{_word('that', 'des')} AS event_ma, {_word('und', 'der')} AS event_earnings, {_word('que')} AS event_management,
  {_word('with', 'para')} AS event_legal,
  CAST(regexp_matches(lower(t), '(^|{_NW})the({_GAP}|{_GAP}[^\\n]{{0,23}}{_GAP})of($|{_NW})') AS INTEGER) AS is_negated,
  {_word('from')} AS is_speculative"""
_WORDS = "string_split_regex(lower({}), '[\\s\\pZ]+')"


def _stem_count(text: str, stems) -> str:
    test = " OR ".join(f"contains(x, '{s}')" for s in stems)
    return f"len(list_filter({_WORDS.format(text)}, lambda x: {test}))"


def lexicon_sql(text: str, rules: TextRules) -> str:
    """Columns p, n, w of a text expression."""
    return f"""{_stem_count(text, rules.positive)} AS p, {_stem_count(text, rules.negative)} AS n,
  len(list_filter({_WORDS.format(text)}, lambda x: x <> '')) AS w"""


LEXICON_CASE = """CASE WHEN p + n = 0 THEN 'neutral' WHEN (p - n) / (p + n) > 0.1 THEN 'positive' WHEN (p - n) / (p + n) < -0.1 THEN 'negative' ELSE 'neutral' END"""
LEXICON_SCORE = "CASE WHEN p + n = 0 THEN 0.0 ELSE round_even((p - n) / (p + n), 3) END"
LEXICON_CONF = "CASE WHEN p + n = 0 THEN 0.0 ELSE round_even(least((p + n) / greatest(w, 1) * 5, 1.0), 3) END"

DOC_MAPPED = """SELECT a.*, m.ticker, CAST(a.published_at AS DATE) AS date FROM v_doc_articles a JOIN v_doc_mentions m ON m.article_url = a.url
UNION ALL SELECT a.*, c.ticker, CAST(a.published_at AS DATE) AS date FROM v_doc_articles a JOIN v_doc_companies c
  ON c.company_name <> '' AND contains(lower(concat_ws(' ', a.title, a.full_text)), lower(c.company_name))
WHERE a.url NOT IN (SELECT article_url FROM v_doc_mentions)"""


@query("P1_map_entities", f"SELECT url, ticker, date, feed_url FROM ({DOC_MAPPED})")
def p1(w):
    return D.map_entities(w.doc_articles, w.doc_companies, w.doc_mentions).select("url", "ticker", "date", "feed_url")


@query("P2_enrich_articles", f"""SELECT url, ticker, {LEXICON_CASE.replace("CASE WHEN", "CASE WHEN sentiment IS NOT NULL THEN sentiment WHEN", 1)} AS sentiment,
 CASE WHEN sentiment IS NOT NULL THEN score ELSE {LEXICON_SCORE} END AS score, CASE WHEN sentiment IS NOT NULL THEN confidence ELSE {LEXICON_CONF} END AS confidence,
 event_ma, event_earnings, event_management, event_legal, is_negated, is_speculative, llm_event_type,
 CASE WHEN llm_event_type = 'ma_deal' THEN 1 ELSE 0 END AS llm_evt_ma_deal
FROM (SELECT x.*, e.event_type AS llm_event_type, {PROSE_FLAGS}, {lexicon_sql('t', PROSE_RULES)}
      FROM (SELECT *, concat_ws(' ', title, full_text) AS t FROM ({DOC_MAPPED})) x LEFT JOIN v_doc_events e ON e.article_url = x.url)""", rounded="score confidence")
def p2(w):
    mapped = D.map_entities(w.doc_articles, w.doc_companies, w.doc_mentions)
    return D.enrich_articles(mapped, w.doc_events, PROSE_RULES).select(
        "url", "ticker", "sentiment", "score", "confidence", "event_ma", "event_earnings", "event_management",
        "event_legal", "is_negated", "is_speculative", "llm_event_type", "llm_evt_ma_deal",
    )


@query("P3_build_features", f"SELECT ticker, date, {', '.join(FEATURE_COLUMNS)} FROM v_features", rounded=" ".join([*DAILY_DOUBLES.split(), *ROLLED]))
def p3(w):
    return w.features


SIGNAL_COLUMNS = ["ticker", "date", *PRICE_DOUBLES.split(), "volume", "direction", "has_news", *FEATURE_COLUMNS]


@query("P4_daily_signals", f"SELECT {', '.join(SIGNAL_COLUMNS)} FROM v_signals",
       rounded=" ".join([*PRICE_DOUBLES.split(), "volume", *DAILY_DOUBLES.split(), *ROLLED]))
def p4(w):
    return w.signals.select(*SIGNAL_COLUMNS)


@query("P5_company_dim", "SELECT * FROM v_dim", rounded="avg_sentiment_all_time")
def p5(w):
    return w.company_dim


@query("P6_sentiment_weekly", "SELECT * FROM v_weekly", rounded=DAILY_DOUBLES)
def p6_weekly(w):
    return D.weekly(w.features)


@query("P6_sentiment_monthly", "SELECT * FROM v_monthly", rounded=DAILY_DOUBLES)
def p6_monthly(w):
    return D.monthly(w.features)


COMMODITY_DOUBLES = "close daily_return close_r3d close_r7d return_r3d return_r7d volatility_r7d"


@query("P7_commodity_daily", "SELECT * FROM v_commodity_daily", rounded=COMMODITY_DOUBLES)
def p7(w):
    return w.commodity_daily


@query("P8_event_facts", "SELECT fingerprint, event_type, event_date, CAST(first_seen AS DATE) AS first_seen, article_count FROM v_facts")
def p8(w):
    return w.event_tables[0].withColumn("first_seen", F.to_date("first_seen"))


@query("P8_event_bridge", "SELECT fingerprint, ticker FROM v_bridge")
def p8_bridge(w):
    return w.event_tables[1]


@query("P33_news_day_dataset", f"SELECT ticker, date, daily_return, next_day_return, direction, {', '.join(FEATURE_COLUMNS[:11])} FROM v_labelled WHERE news_count > 0",
       rounded="daily_return next_day_return avg_sentiment std_sentiment")
def p33(w):
    dataset = w.news_days
    return dataset.select("ticker", "date", "daily_return", "next_day_return", "direction", *FEATURE_COLUMNS[:11])


# --- aggregates --------------------------------------------------------------------------


@query("D1_daily_features", f"SELECT ticker, date, {', '.join(FEATURE_COLUMNS[:11])}, {', '.join(TYPE_FLAGS)} FROM v_daily", rounded="avg_sentiment std_sentiment")
def d1(w):
    return D.daily_features(w.enriched).drop("positive_ratio", "negative_ratio")


@query("D2_guarded_ratios", """SELECT o_custkey AS custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS pos, count(*) FILTER (WHERE o_orderstatus <> 'P') AS base,
 coalesce(count(*) FILTER (WHERE o_orderstatus = 'F') * 1.0 / nullif(count(*) FILTER (WHERE o_orderstatus <> 'P'), 0), 0) AS share FROM orders GROUP BY 1""", rounded="share")
def d2(w):
    counts = w.table("orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("pos"), F.count_if(F.col("o_orderstatus") != "P").alias("base")
    )
    return counts.withColumn("share", ST.ratio(F.col("pos"), F.col("base")))


@query("D3_polarity_features", """SELECT ticker, date, count(DISTINCT url) AS news_count, avg(p) AS avg_sentiment, coalesce(stddev_samp(p), 0) AS std_sentiment
FROM (SELECT *, CASE sentiment WHEN 'positive' THEN 1.0 WHEN 'negative' THEN -1.0 ELSE 0.0 END AS p FROM v_enriched) GROUP BY 1, 2""", rounded="avg_sentiment std_sentiment")
def d3(w):
    numeric = w.enriched.withColumn("label_score", LB.polarity(F.col("sentiment")))
    return D.daily_features(numeric, score="label_score").select("ticker", "date", "news_count", "avg_sentiment", "std_sentiment")


@query("D4_distinct_counts", "SELECT count(DISTINCT ticker) AS tickers, count(DISTINCT article_url) AS articles FROM v_mentions")
def d4(w):
    return w.mentions.agg(F.countDistinct("ticker").alias("tickers"), F.countDistinct("article_url").alias("articles"))


@query("D5_company_stats", """SELECT ticker, count(DISTINCT url) AS total_news_count, avg(score) AS avg_sentiment_all_time, min(date) AS first_article_date, max(date) AS last_article_date
FROM v_enriched GROUP BY ticker""", rounded="avg_sentiment_all_time")
def d5(w):
    return D.company_stats(w.enriched)


@query("D6_top_event_type", """SELECT ticker, top_event_type FROM v_dim WHERE top_event_type IS NOT NULL""")
def d6(w):
    return ST.mode_per_key(w.enriched, "ticker", "llm_event_type", "top_event_type")


@query("D7_weekly_resample", "SELECT ticker, week_start, news_count, avg_sentiment FROM v_weekly", rounded="avg_sentiment")
def d7(w):
    daily = D.daily_features(w.enriched)
    return D.resample(daily, "ticker", D.week_label(F.col("date")), "7 days", "week_start", ["news_count"], ["avg_sentiment"])


@query("D8_monthly_resample", "SELECT ticker, month_start, news_count, avg_sentiment FROM v_monthly", rounded="avg_sentiment")
def d8(w):
    daily = D.daily_features(w.enriched)
    return D.resample(daily, "ticker", D.month_label(F.col("date")), "1 month", "month_start", ["news_count"], ["avg_sentiment"])


@query("D9_column_spec", """SELECT ticker, CAST(sum(news_count) AS BIGINT) AS news_count, avg(positive_ratio) AS positive_ratio, CAST(sum(event_ma) AS BIGINT) AS event_ma FROM v_daily GROUP BY ticker""", rounded="positive_ratio")
def d9(w):
    spec = {"news_count": F.sum, "positive_ratio": F.avg, "event_ma": F.sum}
    return D.daily_features(w.enriched).groupBy("ticker").agg(*[f(c).alias(c) for c, f in spec.items()])


@query("D10_conditional_aggregates", """SELECT avg(next_day_return) FILTER (WHERE llm_evt_ma_deal > 0) AS present,
 avg(next_day_return) FILTER (WHERE llm_evt_ma_deal = 0 OR llm_evt_ma_deal IS NULL) AS absent, count(*) FILTER (WHERE llm_evt_ma_deal > 0) AS n
FROM v_signals WHERE next_day_return IS NOT NULL""", rounded="present absent")
def d10(w):
    r, flag = F.col("next_day_return"), F.col("llm_evt_ma_deal")
    return w.signals.where(r.isNotNull()).agg(
        ST.avg_where(r, flag > 0).alias("present"), ST.avg_where(r, (flag == 0) | flag.isNull()).alias("absent"), F.count_if(flag > 0).alias("n")
    )


@query("D11_avg_nonzero", "SELECT ticker, avg(nullif(avg_sentiment, 0)) AS avg_sentiment FROM v_daily GROUP BY ticker", rounded="avg_sentiment")
def d11(w):
    return D.daily_features(w.enriched).groupBy("ticker").agg(
        F.avg(F.nullif(F.col("avg_sentiment"), F.lit(0.0))).alias("avg_sentiment")
    )


@query("D12_distinct_per_group", "SELECT c.sector, count(DISTINCT m.article_url) AS articles FROM v_mentions m JOIN v_companies c ON c.ticker = m.ticker GROUP BY 1")
def d12(w):
    return w.mentions.join(w.companies.select("ticker", "sector"), "ticker").groupBy("sector").agg(
        F.countDistinct("article_url").alias("articles")
    )


@query("D13_distinct_list", paged_sql("v_event_companies", "event_fingerprint", "ticker"))
def d13(w):
    pages = paged_list(w.event_companies, "event_fingerprint", "ticker", PAGE)
    return pages.select("event_fingerprint", "page", F.array_join("items", ",").alias("items"))


@query("D14_by_period", "SELECT CAST(date_trunc('week', event_date) AS DATE) AS period, count(*) AS n FROM v_article_events GROUP BY 1")
def d14(w):
    return w.article_events.groupBy(F.to_date(F.date_trunc("week", "event_date")).alias("period")).agg(F.count("*").alias("n"))


@query("D15_value_counts", "SELECT event_type, count(*) AS n, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM v_article_events GROUP BY 1", rounded="share")
def d15(w):
    return ST.value_counts(w.article_events, "event_type")


_LEVELS = ["error", "warning", "info"]


@query("D16_pivot", f"SELECT pipeline_name, {', '.join(f'''count(*) FILTER (WHERE level = '{x}') AS {x}''' for x in _LEVELS)} FROM v_log GROUP BY 1")
def d16(w):
    return ST.pivot_table(w.log, "pipeline_name", "level", _LEVELS, F.count(F.lit(1)))


@query("D17_row_shares", f"SELECT pipeline_name, {', '.join(f'''count(*) FILTER (WHERE level = '{x}') * 1.0 / count(*) AS {x}''' for x in _LEVELS)} FROM v_log GROUP BY 1", rounded="error warning info")
def d17(w):
    return ST.row_shares(ST.pivot_table(w.log, "pipeline_name", "level", _LEVELS, F.count(F.lit(1))), _LEVELS)


@query("D18_describe_by_label", """SELECT sentiment, count(score) AS count, avg(score) AS mean, stddev_samp(score) AS std, min(score) AS min, max(score) AS max,
 quantile_cont(score, 0.25) AS q25, quantile_cont(score, 0.5) AS q50, quantile_cont(score, 0.75) AS q75 FROM v_articles WHERE sentiment IS NOT NULL GROUP BY 1""", rounded="mean std min max q25 q50 q75")
def d18(w):
    return Q.describe_by(w.articles, "score", ["sentiment"])


@query("D19_median_by_type", """SELECT e.event_type, median(a.score) AS median FROM v_article_events e JOIN v_articles a ON a.url = e.article_url WHERE a.score IS NOT NULL GROUP BY 1""", rounded="median")
def d19(w):
    scored = w.article_events.select(F.col("article_url").alias("url"), "event_type").join(w.articles.select("url", "score"), "url")
    return Q.exact_quantiles(scored, "score", {"median": 0.5}, ["event_type"])


@query("D20_null_rates", """SELECT * FROM (SELECT 'sentiment' AS "column", round_even(avg(CAST(sentiment IS NULL AS INTEGER)) * 100, 1) AS missing_pct FROM v_articles
 UNION ALL SELECT 'score', round_even(avg(CAST(score IS NULL AS INTEGER)) * 100, 1) FROM v_articles UNION ALL SELECT 'full_text', 100.0 UNION ALL SELECT 'url', 0.0) WHERE missing_pct > 0""", rounded="missing_pct")
def d20(w):
    return ST.null_rates(w.articles, ["url", "sentiment", "score", "full_text"])


@query("D20_completeness", """SELECT 'url' AS "column", 1.0 AS completeness UNION ALL SELECT 'score', avg(CAST(score IS NOT NULL AS INTEGER)) FROM v_articles""", rounded="completeness")
def d20_complete(w):
    return ST.completeness(w.articles, ["url", "score"])


@query("D21_ticker_coverage", """SELECT ticker, count(*) AS total_days, count(*) FILTER (WHERE news_count > 0) AS news_days, avg(next_day_return) AS avg_return, stddev_samp(next_day_return) AS std_return,
 round_even(count(*) FILTER (WHERE news_count > 0) * 1.0 / count(*), 3) AS news_coverage FROM v_labelled GROUP BY 1""", rounded="avg_return std_return news_coverage")
def d21(w):
    dataset = w.labelled
    return dataset.groupBy("ticker").agg(
        F.count("*").alias("total_days"), F.count_if(F.col("news_count") > 0).alias("news_days"),
        F.avg("next_day_return").alias("avg_return"), F.stddev_samp("next_day_return").alias("std_return"),
    ).withColumn("news_coverage", F.bround(F.col("news_days") / F.col("total_days"), 3))


@query("D22_flag_coverage", """SELECT avg(event_ma) * 100 AS ma_pct, avg(event_legal) * 100 AS legal_pct, avg(greatest(event_ma, event_earnings, event_management, event_legal)) * 100 AS any_pct,
 avg(CAST(llm_event_type IS NOT NULL AS INTEGER)) * 100 AS typed_pct FROM v_enriched""", rounded="ma_pct legal_pct any_pct typed_pct")
def d22(w):
    rule = ST.any_of("event_ma", "event_earnings", "event_management", "event_legal")
    return w.enriched.agg(
        (F.avg("event_ma") * 100).alias("ma_pct"), (F.avg("event_legal") * 100).alias("legal_pct"), (F.avg(rule) * 100).alias("any_pct"),
        (F.avg(F.col("llm_event_type").isNotNull().cast("int")) * 100).alias("typed_pct"),
    )


@query("D23_nonzero_days", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} > 0) AS days FROM v_daily""" for c in TYPE_FLAGS))
def d23(w):
    return ST.nonzero_days(D.daily_features(w.enriched), TYPE_FLAGS)


@query("D24_global_stats", """SELECT count(*) AS n, min(next_day_return) AS low, max(next_day_return) AS high, avg(next_day_return) AS mean, avg(direction) AS up_share, min(date) AS first_date FROM v_returns""", rounded="low high mean up_share")
def d24(w):
    return D.add_returns(w.base_prices).agg(
        F.count("*").alias("n"), F.min("next_day_return").alias("low"), F.max("next_day_return").alias("high"),
        F.avg("next_day_return").alias("mean"), F.avg("direction").alias("up_share"), F.min("date").alias("first_date"),
    )


@query("D25_histogram", """SELECT bin, n, n / (sum(n) OVER () * 0.05) AS density FROM (SELECT CAST(least(floor((score + 1) / 0.05) + 1, 40) AS INTEGER) AS bin, count(*) AS n
 FROM (SELECT round(score * 3.1415926, 9) % 1 AS score FROM v_articles) WHERE score BETWEEN -1 AND 1 GROUP BY 1)""", rounded="density")
def d25(w):
    spread = w.articles.select((F.round(F.col("score") * 3.1415926, 9) % 1).alias("score"))
    return ST.histogram(spread, "score", -1.0, 1.0, 40)


@query("D25_histogram_by_label", """SELECT sentiment, bin, n, n / (sum(n) OVER (PARTITION BY sentiment) * 0.05) AS density FROM (SELECT sentiment, CAST(least(floor((score + 1) / 0.05) + 1, 40) AS INTEGER) AS bin, count(*) AS n
 FROM (SELECT sentiment, round(score * 3.1415926, 9) % 1 AS score FROM v_articles WHERE sentiment IS NOT NULL) WHERE score BETWEEN -1 AND 1 GROUP BY 1, 2)""", rounded="density")
def d25_label(w):
    spread = w.articles.where("sentiment IS NOT NULL").select("sentiment", (F.round(F.col("score") * 3.1415926, 9) % 1).alias("score"))
    return ST.histogram(spread, "score", -1.0, 1.0, 40, ["sentiment"])


_EDGES = "[" + ", ".join(f"quantile_cont(round(avg_sentiment, 9), {i / 10})" for i in range(11)) + "]"


@query("D26_sentiment_deciles", f"""SELECT bucket, count(*) AS n, avg(next_day_return) AS mean_return FROM (
 SELECT next_day_return, CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < s)) AS INTEGER) AS bucket
 FROM (SELECT round(avg_sentiment, 9) AS s, next_day_return FROM v_labelled WHERE news_count > 0) CROSS JOIN (SELECT list_sort(list_distinct({_EDGES})) AS e FROM v_labelled WHERE news_count > 0)) GROUP BY 1""", rounded="mean_return")
def d26(w):
    news = w.news_days
    scores = news.select(F.round("avg_sentiment", 9).alias("avg_sentiment"), "next_day_return")
    return Q.quantile_bucket(scores, "avg_sentiment", 10).groupBy("bucket").agg(
        F.count("*").alias("n"), F.avg("next_day_return").alias("mean_return")
    )


_CORR = ["news_count", "avg_sentiment", "positive_ratio", "event_ma", "event_earnings", "event_management", "event_legal"]


@query("D27_feature_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", CASE WHEN count(*) >= 31 AND NOT isnan(corr({a}, {b})) THEN corr({a}, {b}) END AS r, count(*) AS n FROM v_daily" for i, a in enumerate(_CORR) for b in _CORR[i + 1:]), rounded="r")
def d27(w):
    return ST.correlation_pairs(D.daily_features(w.enriched), _CORR)


@query("D28_guarded_correlation", """SELECT ticker, count(*) AS n, CASE WHEN count(*) >= 10 AND count(DISTINCT avg_sentiment) > 1 THEN corr(avg_sentiment, next_day_return) END AS r
FROM v_labelled WHERE news_count > 0 GROUP BY ticker""", rounded="r")
def d28(w):
    news = w.news_days
    return news.groupBy("ticker").agg(
        F.count("*").alias("n"), ST.pearson(F.col("avg_sentiment"), F.col("next_day_return"), 10).alias("r")
    )


@query("D29_trend_line", """SELECT regr_slope(next_day_return, avg_sentiment) AS slope, regr_intercept(next_day_return, avg_sentiment) AS intercept, corr(next_day_return, avg_sentiment) AS r, count(*) AS n
FROM v_labelled WHERE news_count > 0""", rounded="slope intercept r")
def d29(w):
    news = w.news_days
    return ST.linear_fit(news, "avg_sentiment", "next_day_return")


@query("D30_spearman", """SELECT corr(rx, ry) AS rho, count(*) AS n FROM (
 SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
 FROM (SELECT round(avg_sentiment, 9) AS x, next_day_return AS y FROM v_labelled WHERE news_count > 0))""", rounded="rho")
def d30(w):
    news = w.news_days
    return ST.spearman(news.select(F.round("avg_sentiment", 9).alias("x"), F.col("next_day_return").alias("y")), "x", "y")


@query("D30_sign_agreement", """SELECT avg(CAST(sign(pred_return) = sign(next_day_return) AS INTEGER)) AS share FROM v_predictions""", rounded="share")
def d30_sign(w):
    return w.predictions.agg(ST.sign_agreement(F.col("pred_return"), F.col("next_day_return")).alias("share"))


@query("D31_event_counters", """SELECT fingerprint, count(DISTINCT article_url) AS article_count, count(*) AS analysis_count, CAST(min(analyzed_at) AS DATE) AS first_seen FROM v_article_events GROUP BY 1""")
def d31(w):
    return G.event_counters(w.article_events, "analyzed_at").withColumn("first_seen", F.to_date("first_seen"))


@query("D32_run_kpis", """SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed,
 CAST(sum(rows_processed) AS BIGINT) AS rows_processed, CAST(sum(rows_failed) AS BIGINT) AS rows_failed,
 count(*) FILTER (WHERE status = 'success') * 100.0 / nullif(count(*) FILTER (WHERE status IN ('success', 'failed')), 0) AS success_rate FROM v_runs""", rounded="success_rate")
def d32(w):
    from tickerloom.operators.harvest import run_kpis

    return run_kpis(w.runs)


@query("D33_breadth", """SELECT avg(CAST(coalesce(change_pct > 0, false) AS INTEGER)) * 100 AS advancing_pct, avg(avg_sentiment_r7d) AS market_sentiment FROM (
 SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM v_signals) WHERE rn = 1""", rounded="advancing_pct market_sentiment")
def d33(w):
    from tickerloom.plans.dashboards import headline_kpis, market_latest

    latest = market_latest(w.signals, w.companies)
    return headline_kpis(w.companies, latest, w.signals).select("advancing_pct", "market_sentiment")


# --- windows -----------------------------------------------------------------------------

_E1 = [f"{c}_r{n}d" for n in (3, 7) for c in ROLL_BASE]


@query("E1_rolling_means", f"SELECT ticker, date, {', '.join(_E1)} FROM v_features", rounded=" ".join(_E1))
def e1(w):
    return D.rolling_mean(D.daily_features(w.enriched), "ticker", "date", ROLL_BASE).select("ticker", "date", *_E1)


@query("E2_rolling_std", "SELECT asset_key, date, volatility_r7d FROM v_commodity_daily", rounded="volatility_r7d")
def e2(w):
    return w.commodity_daily.select("asset_key", "date", "volatility_r7d")


@query("E3_rolling_price_return", "SELECT asset_key, date, close_r3d, close_r7d, return_r3d, return_r7d FROM v_commodity_daily", rounded="close_r3d close_r7d return_r3d return_r7d")
def e3(w):
    return w.commodity_daily.select("asset_key", "date", "close_r3d", "close_r7d", "return_r3d", "return_r7d")


@query("E4_pct_change", "SELECT ticker, date, daily_return FROM v_returns", rounded="daily_return")
def e4(w):
    return D.add_returns(w.base_prices).select("ticker", "date", "daily_return")


@query("E5_next_return", "SELECT ticker, date, next_day_return FROM v_returns", rounded="next_day_return")
def e5(w):
    return D.add_returns(w.base_prices).select("ticker", "date", "next_day_return")


@query("E6_direction", "SELECT ticker, date, direction FROM v_returns")
def e6(w):
    return D.add_returns(w.base_prices).select("ticker", "date", "direction")


@query("E6_direction_labelled", "SELECT ticker, date, direction FROM v_returns WHERE next_day_return IS NOT NULL")
def e6_labelled(w):
    return D.add_returns(w.base_prices, drop_unlabelled=True).select("ticker", "date", "direction")


_INDEX = "SELECT date, avg(daily_return) / 1000 AS r FROM v_commodity_returns GROUP BY date"
_CUM = f"SELECT date, r, product(1 + coalesce(r, 0)) OVER (ORDER BY date) AS cum FROM ({_INDEX})"


def _index(w):
    """Equal-weight asset returns per day, damped so that the curve stays in range."""
    daily = w.commodity_daily.groupBy("date").agg((F.avg("daily_return") / 1000).alias("r"))
    return daily.withColumn("cum", MK.cumulative("r"))


@query("E10_cumulative_product", _CUM, rounded="r cum")
def e10(w):
    return _index(w)


@query("E11_drawdown", f"SELECT date, (cum - max(cum) OVER (ORDER BY date)) / max(cum) OVER (ORDER BY date) AS drawdown FROM ({_CUM})", rounded="drawdown")
def e11(w):
    return MK.drawdown(_index(w), "cum").select("date", "drawdown")


@query("E12_expected_return", """SELECT ticker, date, expected, daily_return - expected AS ar FROM (SELECT ticker, date, daily_return,
 median(daily_return) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 120 PRECEDING AND 60 PRECEDING) AS expected FROM v_returns)""", rounded="expected ar")
def e12(w):
    return MK.abnormal_returns(D.add_returns(w.base_prices)).select("ticker", "date", "expected", "ar")


@query("E13_share_of_total", "SELECT language, n, n * 1.0 / sum(n) OVER () AS share FROM (SELECT language, count(*) AS n FROM v_doc_articles GROUP BY 1)", rounded="share")
def e13(w):
    return ST.value_counts(w.doc_articles, "language")


@query("E14_carry_forward", """SELECT asset_key, date, last_value(close IGNORE NULLS) OVER (PARTITION BY asset_key ORDER BY date ROWS UNBOUNDED PRECEDING) AS close, coalesce(daily_return, 0) AS daily_return FROM (
 SELECT asset_key, date, CASE WHEN day(date) % 5 <> 0 THEN close END AS close, daily_return FROM v_commodity_returns)""", rounded="close daily_return")
def e14(w):
    gaps = w.commodity_daily.select(
        "asset_key", "date", F.when(F.dayofmonth("date") % 5 != 0, F.col("close")).alias("close"), "daily_return"
    )
    return D.carry_forward(gaps, "asset_key", "date", ["close"], ["daily_return"])


@query("E15_best_per_day", """SELECT date, ticker, p_up, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY p_up DESC, ticker) AS rank FROM v_predictions) WHERE rank <= 3""", rounded="p_up")
def e15(w):
    return KY.top_per_key(w.predictions.select("date", "ticker", "p_up"), "date", 3, F.desc("p_up"), F.asc("ticker"))


@query("F6_one_hot", f"SELECT article_url, {', '.join(f'''CAST(event_type = '{t}' AS INTEGER) AS is_{t}''' for t in EVENT_TYPES)} FROM v_article_events")
def f6(w):
    return w.article_events.select("article_url", *LB.one_hot(F.col("event_type"), EVENT_TYPES, "is_"))


@query("F25_bands", """SELECT url, CASE WHEN score > 0.05 THEN 'positive' WHEN score < -0.05 THEN 'negative' ELSE 'neutral' END AS band,
 CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.5 THEN 'medium' ELSE 'low' END AS completeness FROM v_articles WHERE score IS NOT NULL""")
def f25(w):
    scored = w.articles.where("score IS NOT NULL")
    return scored.select("url", LB.sentiment_band(F.col("score")).alias("band"), LB.completeness_band(F.col("confidence")).alias("completeness"))


@query("P22_wide_returns", f"""SELECT * FROM (SELECT date, {', '.join(f'"{b}" / nullif(lag("{b}") OVER (ORDER BY date), 0) - 1 AS "{b}_ret"' for b in BRANDS)}
FROM (SELECT date, {', '.join(f"max(close) FILTER (WHERE asset_key = '{b}') AS " + '"' + b + '"' for b in BRANDS)} FROM v_commodities GROUP BY date))
WHERE coalesce({', '.join(f'"{b}_ret"' for b in BRANDS)}) IS NOT NULL""", rounded=" ".join(f"{b}_ret" for b in BRANDS))
def p22(w):
    return MK.wide_returns(MK.wide_closes(w.commodities, BRANDS))


@query("P23_correlation_pairs", f"""WITH wide AS (SELECT date, {', '.join(f"max(close) FILTER (WHERE asset_key = '{b}') AS " + f'b{i}' for i, b in enumerate(BRANDS))} FROM v_commodities GROUP BY date),
 ret AS (SELECT {', '.join(f'b{i} / nullif(lag(b{i}) OVER (ORDER BY date), 0) - 1 AS r{i}' for i in range(25))} FROM wide)
SELECT * FROM ({' UNION ALL '.join(f"SELECT '{BRANDS[i]}' AS " + '"left"' + f", '{BRANDS[j]}' AS " + '"right"' + f", CASE WHEN regr_count(r{i}, r{j}) >= 31 AND NOT isnan(corr(r{i}, r{j})) THEN corr(r{i}, r{j}) END AS r, regr_count(r{i}, r{j}) AS n FROM ret" for i in range(25) for j in range(i + 1, 25))})
ORDER BY round(abs(r), 9) DESC NULLS LAST, "left", "right" LIMIT 15""", rounded="r")
def p23(w):
    return MK.return_correlations(w.commodities, BRANDS, 15)



