"""Registered queries: report pages, run logs, capture statistics, market analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.constants import EVENT_TYPES
from tickerloom.functions.parse import lookup
from tickerloom.operators import daily as D
from tickerloom.operators import harvest as H
from tickerloom.operators import intake as IN
from tickerloom.operators import market as MK
from tickerloom.plans import dashboards as DB
from tickerloom.plans.catalog import query
from tickerloom.plans.catalog_tables import EVENT_DAYS_SQL, event_days


# --- report pages ------------------------------------------------------------------------

_LATEST = """SELECT s.ticker, c.company_name, c.sector, s.date, s.close, s.change_pct, s.daily_return, s.volume, s.news_count, s.avg_sentiment, s.avg_sentiment_r7d, s.positive_ratio, s.negative_ratio
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM v_signals) s JOIN v_companies c ON c.ticker = s.ticker WHERE rn = 1"""
_LATEST_DOUBLES = "close change_pct daily_return volume avg_sentiment avg_sentiment_r7d positive_ratio negative_ratio"


@query("P9_event_impact", " UNION ALL ".join(f"""SELECT * FROM (SELECT '{t}' AS event_type, count(*) FILTER (WHERE llm_evt_{t} > 0) AS n_days,
 avg(next_day_return) FILTER (WHERE llm_evt_{t} > 0) AS present, avg(next_day_return) FILTER (WHERE llm_evt_{t} = 0) AS absent,
 avg(next_day_return) FILTER (WHERE llm_evt_{t} > 0) - coalesce(avg(next_day_return) FILTER (WHERE llm_evt_{t} = 0), 0) AS lift FROM v_labelled) WHERE n_days > 0 AND present IS NOT NULL""" for t in DB.IMPACT_TYPES),
       rounded="present absent lift")
def p9(w):
    return DB.event_impact(w.signals)


@query("P10_market_latest", _LATEST, rounded=_LATEST_DOUBLES)
def p10(w):
    return DB.market_latest(w.signals, w.companies)


@query("P10_top_gainers", f"SELECT ticker, company_name, change_pct FROM ({_LATEST}) WHERE change_pct IS NOT NULL ORDER BY change_pct DESC, ticker LIMIT 10", rounded="change_pct")
def p10_gainers(w):
    return DB.movers(DB.market_latest(w.signals, w.companies)).select("ticker", "company_name", "change_pct")


@query("K4_top_losers", f"SELECT ticker, change_pct FROM ({_LATEST}) WHERE change_pct IS NOT NULL ORDER BY change_pct, ticker LIMIT 10", rounded="change_pct")
def k4(w):
    return DB.movers(DB.market_latest(w.signals, w.companies), losers=True).select("ticker", "change_pct")


_SINCE = "date >= (SELECT max(date) FROM v_base_prices) - {}"


@query("P11_news_flow", f"SELECT date, CAST(sum(news_count) AS BIGINT) AS news_count, avg(nullif(avg_sentiment, 0)) AS avg_sentiment FROM v_signals WHERE has_news AND {_SINCE.format(400)} GROUP BY 1", rounded="avg_sentiment")
def p11(w):
    return DB.news_flow(w.signals, 400)


@query("P12_sector_sentiment", f"""SELECT c.sector, avg(s.avg_sentiment) AS avg_sentiment, CAST(sum(s.news_count) AS BIGINT) AS news_count, count(DISTINCT s.ticker) AS companies
FROM v_signals s JOIN v_companies c ON c.ticker = s.ticker WHERE s.has_news AND c.sector IS NOT NULL AND s.{_SINCE.format(400)} GROUP BY 1""", rounded="avg_sentiment")
def p12(w):
    return DB.sector_sentiment(w.signals, w.companies, 400)


_PAIRS = f"""SELECT s.ticker, c.sector, s.date, s.avg_sentiment, s.news_count, s.daily_return, s.next_day_return FROM v_signals s JOIN v_companies c ON c.ticker = s.ticker
WHERE s.has_news AND s.avg_sentiment IS NOT NULL AND s.{_SINCE.format(730)}"""


def _guarded_corr(y: str) -> str:
    return f"CASE WHEN count({y}) >= 10 AND NOT isnan(corr(avg_sentiment, {y})) THEN corr(avg_sentiment, {y}) END"


@query("P13_sentiment_return_pairs", _PAIRS, rounded="avg_sentiment daily_return next_day_return")
def p13(w):
    return DB.sentiment_return_pairs(w.signals, w.companies, 730)


@query("P13_lead_lag", f"""SELECT ticker, min(sector) AS sector, count(next_day_return) AS news_days, {_guarded_corr('daily_return')} AS corr_same_day, {_guarded_corr('next_day_return')} AS corr_next_day
FROM ({_PAIRS}) GROUP BY ticker""", rounded="corr_same_day corr_next_day")
def p13_lags(w):
    return DB.lead_lag(DB.sentiment_return_pairs(w.signals, w.companies, 730))


@query("P13_trend_line", f"""WITH p AS ({_PAIRS}), b AS (SELECT quantile_cont(next_day_return, 0.01) AS lo, quantile_cont(next_day_return, 0.99) AS hi FROM p)
SELECT regr_slope(next_day_return, avg_sentiment) AS slope, regr_intercept(next_day_return, avg_sentiment) AS intercept, corr(next_day_return, avg_sentiment) AS r, count(*) AS n
FROM p, b WHERE next_day_return BETWEEN lo AND hi""", rounded="slope intercept r")
def p13_line(w):
    return DB.sentiment_trend_line(DB.sentiment_return_pairs(w.signals, w.companies, 730))


_TICKERS = "SELECT fingerprint, string_agg(ticker, ', ' ORDER BY ticker) AS tickers FROM v_bridge GROUP BY 1"


@query("P14_event_list", f"""SELECT f.fingerprint, f.event_type, f.event_date, CAST(f.first_seen AS DATE) AS first_seen, f.article_count, t.tickers
FROM v_facts f LEFT JOIN ({_TICKERS}) t USING (fingerprint) WHERE f.event_date IS NOT NULL ORDER BY f.event_date DESC, f.fingerprint LIMIT 500""")
def p14(w):
    return DB.event_list(*w.event_tables, limit=500).withColumn("first_seen", F.to_date("first_seen"))


@query("P15_events_over_time", "SELECT CAST(date_trunc('month', event_date) AS DATE) AS period, event_type, count(*) AS n FROM v_facts GROUP BY 1, 2")
def p15(w):
    return DB.events_over_time(w.event_tables[0])


@query("P15_events_over_time_wide", f"""SELECT CAST(date_trunc('week', event_date) AS DATE) AS period, {', '.join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)} FROM v_facts GROUP BY 1""")
def p15_wide(w):
    return DB.events_over_time_wide(w.event_tables[0], "week")


@query("P16_most_active", """SELECT b.ticker, c.company_name, c.sector, count(DISTINCT b.fingerprint) AS event_count FROM v_bridge b JOIN v_companies c ON c.ticker = b.ticker
GROUP BY 1, 2, 3 ORDER BY event_count DESC, ticker LIMIT 15""")
def p16(w):
    return DB.most_active(w.event_tables[1], w.companies)


@query("P17_ticker_events", "SELECT f.event_type, f.event_date, f.article_count FROM v_bridge b JOIN v_facts f ON f.fingerprint = b.fingerprint WHERE b.ticker = '7'")
def p17(w):
    return DB.ticker_events(*w.event_tables, "7")


@query("P17_ticker_daily", f"SELECT ticker, date, close, news_count, avg_sentiment FROM v_signals WHERE ticker = '7' AND {_SINCE.format(365)}", rounded="close avg_sentiment")
def p17_daily(w):
    return DB.ticker_daily(w.signals, "7").select("ticker", "date", "close", "news_count", "avg_sentiment")


@query("P17_ticker_weekly", "SELECT ticker, week_start, news_count, avg_sentiment FROM v_weekly WHERE ticker = '7'", rounded="avg_sentiment")
def p17_weekly(w):
    return DB.ticker_periods(D.weekly(w.features), "7", "week_start").select("ticker", "week_start", "news_count", "avg_sentiment")


@query("P18_commodity_snapshot", """SELECT asset_key, name, category, date, close, daily_return, return_r7d, volatility_r7d FROM (SELECT *, row_number() OVER (PARTITION BY asset_key ORDER BY date DESC) AS rn FROM v_commodity_daily) WHERE rn = 1""", rounded="close daily_return return_r7d volatility_r7d")
def p18(w):
    return DB.commodity_snapshot(w.commodity_daily)


@query("P18_commodity_history", """SELECT date, close, daily_return FROM v_commodity_daily WHERE asset_key = 'Brand#3' AND date >= (SELECT max(date) FROM v_commodities) - 180""", rounded="close daily_return")
def p18_history(w):
    return DB.commodity_history(w.commodity_daily, "Brand#3")


@query("P19_sector_event_matrix", f"""SELECT c.sector, {', '.join(f"count(DISTINCT f.fingerprint) FILTER (WHERE f.event_type = '{t}') AS {t}" for t in EVENT_TYPES)}
FROM v_bridge b JOIN v_facts f ON f.fingerprint = b.fingerprint JOIN v_companies c ON c.ticker = b.ticker GROUP BY 1""")
def p19(w):
    return DB.sector_event_matrix(*w.event_tables, w.companies)


@query("P20_source_mix", "SELECT f.name AS source, a.sentiment, count(*) AS n FROM v_articles a JOIN v_feeds f ON f.url = a.feed_url GROUP BY 1, 2")
def p20(w):
    return DB.source_mix(w.articles, w.feeds)


@query("P20_feed_mix_top", """SELECT feed_url, coalesce(count(*) FILTER (WHERE sentiment = 'positive') * 100.0 / nullif(count(*) FILTER (WHERE sentiment IN ('positive', 'neutral', 'negative')), 0), NULL) AS positive,
 count(*) FILTER (WHERE sentiment = 'neutral') * 100.0 / nullif(count(*) FILTER (WHERE sentiment IN ('positive', 'neutral', 'negative')), 0) AS neutral,
 count(*) FILTER (WHERE sentiment = 'negative') * 100.0 / nullif(count(*) FILTER (WHERE sentiment IN ('positive', 'neutral', 'negative')), 0) AS negative
FROM v_doc_articles WHERE feed_url IN (SELECT feed_url FROM v_doc_articles GROUP BY 1 ORDER BY count(*) DESC, feed_url LIMIT 8) GROUP BY 1""", rounded="positive neutral negative")
def p20_top(w):
    return DB.feed_mix(w.doc_articles, "feed_url")


@query("P21_monthly_sentiment", "SELECT strftime(published_at, '%Y-%m') AS month, avg(score) AS avg_score FROM v_articles WHERE score IS NOT NULL GROUP BY 1", rounded="avg_score")
def p21(w):
    return DB.monthly_sentiment(w.articles)


@query("P21_monthly_articles", """SELECT last_day(m) AS month_end, count(a.url) AS n FROM (SELECT unnest(generate_series(CAST(date_trunc('month', min(published_at)) AS DATE), CAST(max(published_at) AS DATE), INTERVAL 1 MONTH)) AS m FROM v_articles) g
LEFT JOIN v_articles a ON date_trunc('month', a.published_at) = g.m GROUP BY 1""")
def p21_counts(w):
    return DB.monthly_articles(w.articles)


@query("F23_label_lookup", """SELECT event_type, CASE event_type WHEN 'ma_deal' THEN 'M&A' WHEN 'other' THEN 'Other' ELSE event_type END AS label, count(*) AS n FROM v_article_events GROUP BY 1""")
def f23(w):
    code = F.col("event_type")
    return w.article_events.groupBy("event_type").agg(F.count("*").alias("n")).withColumn(
        "label", lookup({"ma_deal": "M&A", "other": "Other"}, code, code)
    )


# --- run log and captures ----------------------------------------------------------------

_AS_OF = "2024-01-20 12:00:00"
_NOW = "TIMESTAMP '2024-01-20 12:00:00'"


@query("N1_run_records", "SELECT run_id, pipeline_name, CAST(started_at AS DATE) AS day, status, rows_processed, rows_failed FROM v_runs")
def n1(w):
    return w.runs.select("run_id", "pipeline_name", F.to_date("started_at").alias("day"), "status", "rows_processed", "rows_failed")


@query("N2_recent_runs", f"SELECT run_id, status, rows_processed FROM v_runs WHERE started_at >= {_NOW} - INTERVAL 1 DAY")
def n2(w):
    return H.recent_runs(w.runs, _AS_OF).select("run_id", "status", "rows_processed")


@query("N2_run_trend", f"SELECT CAST(started_at AS DATE) AS day, pipeline_name, status, count(*) AS runs, CAST(sum(rows_processed) AS BIGINT) AS rows_processed FROM v_runs WHERE started_at >= {_NOW} - INTERVAL 7 DAY GROUP BY 1, 2, 3")
def n2_trend(w):
    return H.run_trend(w.runs, _AS_OF)


@query("N2_recent_problems", f"SELECT id, level FROM v_log WHERE level IN ('warning', 'error') AND ts >= {_NOW} - INTERVAL 1 DAY ORDER BY ts DESC, id DESC LIMIT 50")
def n2_problems(w):
    return H.recent_problems(w.log, _AS_OF, limit=50).select("id", "level")


@query("N3_run_list", "SELECT run_id, status FROM v_runs WHERE pipeline_name = 'p1'")
def n3(w):
    return H.run_list(w.runs, name="p1").select("run_id", "status")


@query("N3_run_detail", "SELECT id, level, metric_name, metric_value FROM v_log WHERE run_id = 'p1-2024-01-03-2' AND metric_name IS NOT NULL", rounded="metric_value")
def n3_detail(w):
    return H.run_detail(w.log, "p1-2024-01-03-2").where("metric_name IS NOT NULL").select("id", "level", "metric_name", "metric_value")


@query("N3_level_counts", "SELECT level, count(*) AS n, CASE level WHEN 'error' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END AS position FROM v_log GROUP BY 1")
def n3_levels(w):
    return H.level_counts(w.log)


@query("N4_daily_coverage", "SELECT CAST(ts AS DATE) AS day, count(DISTINCT pipeline_name) AS covered, count(*) AS n FROM v_log GROUP BY 1")
def n4(w):
    return w.log.groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("pipeline_name").alias("covered"), F.count("*").alias("n"))


@query("N4_latest_snapshot", "SELECT ticker, date, close FROM v_base_prices WHERE date = (SELECT max(date) FROM v_base_prices)", rounded="close")
def n4_latest(w):
    newest = w.base_prices.agg(F.max("date")).scalar()
    return w.base_prices.where(F.col("date") == newest).select("ticker", "date", "close")


_STATS = """count(*) AS indexed, count(*) FILTER (WHERE coalesce(raw_html_path, '') <> '') AS fetched, count(*) FILTER (WHERE coalesce(raw_html_path, '') = '') AS pending,
 min(capture_timestamp) AS oldest, max(capture_timestamp) AS newest, count(*) FILTER (WHERE raw_html_path <> '' AND original_published_date IS NOT NULL) AS with_date,
 count(*) FILTER (WHERE raw_html_path <> '' AND original_published_date IS NULL) AS without_date"""


@query("N6_domain_stats", f"SELECT domain, {_STATS} FROM v_captures GROUP BY domain")
def n6(w):
    return H.domain_stats(w.captures)


@query("N6_by_month", "SELECT domain, coalesce(strftime(original_published_date, '%Y-%m'), substr(capture_timestamp, 1, 4) || '-' || substr(capture_timestamp, 5, 2)) AS month, count(*) AS n FROM v_captures GROUP BY 1, 2")
def n6_month(w):
    return H.captures_by_month(w.captures, "domain")


@query("N7_domain_totals", f"SELECT domain, {_STATS} FROM v_captures GROUP BY domain UNION ALL SELECT 'TOTAL', {_STATS} FROM v_captures")
def n7(w):
    return H.domain_totals(w.captures)


@query("N7_by_month_merged", "SELECT coalesce(strftime(original_published_date, '%Y-%m'), substr(capture_timestamp, 1, 4) || '-' || substr(capture_timestamp, 5, 2)) AS month, count(*) AS n FROM v_captures GROUP BY 1")
def n7_month(w):
    return H.captures_by_month(w.captures)


@query("N8_asset_summary", """SELECT a.asset_key, min(c.date) AS first_date, max(c.date) AS last_date, count(c.date) AS rows, CASE WHEN count(c.date) = 0 THEN 'MISSING' ELSE 'OK' END AS status
FROM (SELECT DISTINCT p_brand AS asset_key FROM part UNION SELECT DISTINCT p_type FROM part) a LEFT JOIN v_commodities c ON c.asset_key = a.asset_key GROUP BY 1""")
def n8(w):
    parts = w.table("part")
    assets = parts.select(F.col("p_brand").alias("asset_key")).union(parts.select("p_type")).distinct()
    return MK.asset_summary(assets, w.commodities)


@query("I6_fetch_rate", f"SELECT count(*) FILTER (WHERE {_NOW} - ts <= INTERVAL 1 HOUR) AS recent, count(*) FILTER (WHERE {_NOW} - ts <= INTERVAL 1 HOUR) * 1.0 AS per_hour FROM v_log", rounded="per_hour")
def i6(w):
    return H.fetch_rate(w.log, "ts", _AS_OF)


# --- market analytics --------------------------------------------------------------------

_STUDY = f"""WITH ar AS (SELECT ticker, date, volume, daily_return - median(daily_return) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 120 PRECEDING AND 60 PRECEDING) AS ar FROM v_returns),
s AS (SELECT *, CASE WHEN count(ar) OVER w = 5 THEN sum(ar) OVER w END AS car, stddev_samp(ar) OVER (PARTITION BY ticker) AS ar_sigma
      FROM ar WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 PRECEDING AND 3 FOLLOWING))
SELECT e.url, e.ticker, s.date AS session, s.car, abs(s.car) > 1.5 * s.ar_sigma AS significant
FROM ({EVENT_DAYS_SQL}) e ASOF JOIN s ON s.ticker = e.ticker AND e.day <= s.date WHERE s.car IS NOT NULL"""


def _study(w, **options):
    return MK.event_study(event_days(w), w.base_prices, "day", **options)


@query("P29_event_study", _STUDY, rounded="car")
def p29(w):
    return _study(w).select("url", "ticker", "session", "car", "significant")


@query("P29_mean_car_by_type", f"""SELECT t.event_type, avg(x.car) AS mean_car, avg(abs(x.car)) AS mean_abs_car, count(*) AS n FROM ({_STUDY}) x JOIN v_article_events t ON t.article_url = x.url GROUP BY 1""", rounded="mean_car mean_abs_car")
def p29_types(w):
    types = w.article_events.select(F.col("article_url").alias("url"), "event_type")
    return _study(w, sigma="events").join(types, "url").groupBy("event_type").agg(
        F.avg("car").alias("mean_car"), F.avg(F.abs("car")).alias("mean_abs_car"), F.count("*").alias("n")
    )


# Test prices jump by large factors, so predicted returns are damped before compounding.
_DAMP = "SELECT ticker, date, direction, pred_direction, p_up, pred_return, next_day_return / 1000 AS next_day_return FROM v_predictions"
_BACK = f"""SELECT *, product(1 + coalesce(strategy, 0)) OVER (ORDER BY date) AS cum_strategy, product(1 + coalesce(bh, 0)) OVER (ORDER BY date) AS cum_bh FROM (
 SELECT date, avg(next_day_return * pred_direction) AS strategy, avg(next_day_return) AS bh, CAST(sum(pred_direction) AS BIGINT) AS n_pos, count(pred_direction) AS n_total FROM ({_DAMP}) GROUP BY date)"""


def _damped(w):
    return w.predictions.withColumn("next_day_return", F.col("next_day_return") / 1000)


# The curves reach tens of thousands: three decimals are what a product of 2,500 factors holds.
@query("P24_backtest", f"SELECT * REPLACE (round(cum_strategy + 3.17e-6, 3) AS cum_strategy, round(cum_bh + 3.17e-6, 3) AS cum_bh) FROM ({_BACK})", rounded="strategy bh")
def p24(w):
    curves = MK.backtest(_damped(w))
    return curves.withColumns({c: F.round(F.col(c) + 3.17e-6, 3) for c in ("cum_strategy", "cum_bh")})


def _performance_sql(long: str, rf: float) -> str:
    return f"""SELECT series, total_return, pow(1 + total_return, 252.0 / n) - 1 AS annual_return, sd * sqrt(252) AS annualised_vol, coalesce((m - {rf} / 252) * sqrt(252) / nullif(sd, 0), 0) AS sharpe,
 mdd AS max_drawdown, win_rate, (pow(1 + total_return, 252.0 / n) - 1) / nullif(abs(mdd), 0) AS calmar FROM (
 SELECT series, product(1 + coalesce(r, 0)) - 1 AS total_return, count(r) AS n, stddev_samp(r) AS sd, avg(r) AS m, avg(CAST(coalesce(r, 0) > 0 AS INTEGER)) AS win_rate, min(cum / top - 1) AS mdd FROM (
  SELECT *, max(cum) OVER (PARTITION BY series ORDER BY date) AS top FROM (SELECT *, product(1 + coalesce(r, 0)) OVER (PARTITION BY series ORDER BY date) AS cum FROM ({long}))) GROUP BY series)"""


_PERF = "total_return annual_return annualised_vol sharpe max_drawdown win_rate calmar"


@query("P25_performance", _performance_sql(f"SELECT 'strategy' AS series, date, strategy AS r FROM ({_BACK}) UNION ALL SELECT 'bh', date, bh FROM ({_BACK})", 0.0), rounded=_PERF)
def p25(w):
    return MK.performance(MK.long_series(MK.backtest(_damped(w)), ["strategy", "bh"]))


@query("P26_signal_quality", f"""SELECT ticker, count(*) AS n, avg(pred_direction) AS pred_up_rate, avg(direction) AS actual_up_rate, avg(CAST(pred_direction = direction AS INTEGER)) AS accuracy,
 product(1 + next_day_return * pred_direction) - 1 AS total_return FROM ({_DAMP}) GROUP BY 1""", rounded="pred_up_rate actual_up_rate accuracy total_return")
def p26(w):
    return MK.signal_quality(_damped(w))


def _rule_sql(name: str, score: str, test: str, picks: int) -> str:
    return f"""SELECT '{name}' AS series, d.date, coalesce(r, 0) AS r, coalesce(n_pos, 0) AS n_pos FROM (SELECT DISTINCT date FROM v_predictions) d
LEFT JOIN (SELECT date, avg(next_day_return) AS r, count(*) AS n_pos FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY {score} DESC, ticker) AS rk FROM ({_DAMP}) WHERE {test}) WHERE rk <= {picks} GROUP BY date) x ON x.date = d.date"""


_STRATEGIES = " UNION ALL ".join([
    _rule_sql("S1", "p_up", "p_up >= 0.55", 1), _rule_sql("S2", "pred_return", "pred_return > 0.005", 1), _rule_sql("S3", "p_up", "true", 3),
])


@query("P27_strategies", _STRATEGIES, rounded="r")
def p27(w):
    return MK.three_strategies(_damped(w))


@query("P27_strategy_performance", _performance_sql(_STRATEGIES, 0.035), rounded=_PERF)
def p27_performance(w):
    return MK.performance(MK.three_strategies(_damped(w)), risk_free=0.035)


@query("P28_monthly_returns", f"""SELECT CAST(year(date) AS INTEGER) AS year, {', '.join(f'product(1 + coalesce(strategy, 0)) FILTER (WHERE month(date) = {m}) - 1 AS m{m:02d}' for m in range(1, 13))} FROM ({_BACK}) GROUP BY 1""",
       rounded=" ".join(f"m{m:02d}" for m in range(1, 13)))
def p28(w):
    return MK.monthly_returns(MK.backtest(_damped(w)), "strategy")


# --- intake jobs -------------------------------------------------------------------------

_FX = """SELECT strftime(o_orderdate, '%d/%m/%Y') AS date, CASE o_orderkey % 4 WHEN 0 THEN '1 EURO' WHEN 1 THEN '100 YENS JAPONAIS' WHEN 2 THEN '' ELSE '10 ECUS' END AS devise,
 o_orderpriority AS pays, replace(CAST(o_totalprice AS VARCHAR), '.', ',') AS buy FROM orders"""


def _fx_raw(w):
    key = F.col("o_orderkey") % 4
    return w.table("orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
        F.when(key == 0, "1 EURO").when(key == 1, "100 YENS JAPONAIS").when(key == 2, "").otherwise("10 ECUS").alias("devise"),
        F.col("o_orderpriority").alias("pays"),
        F.replace(F.expr("format_number(o_totalprice, '0.00')"), F.lit("."), F.lit(",")).alias("buy"), F.lit("n/a").alias("sell"),
    )


@query("P30_fx_rates", f"""SELECT CAST(strptime(date, '%d/%m/%Y') AS DATE) AS rate_date, CASE devise WHEN '1 EURO' THEN 'EUR' WHEN '100 YENS JAPONAIS' THEN 'JPY' ELSE devise END AS currency, pays AS country,
 CAST(split_part(devise, ' ', 1) AS INTEGER) AS unit, CAST(replace(buy, ',', '.') AS DOUBLE) AS buy_rate, CAST(NULL AS DOUBLE) AS sell_rate FROM ({_FX}) WHERE devise <> ''""", rounded="buy_rate sell_rate")
def p30(w):
    return IN.clean_fx_rates(_fx_raw(w))[0]


@query("F24_currency_code", f"SELECT CASE devise WHEN '1 EURO' THEN 'EUR' WHEN '100 YENS JAPONAIS' THEN 'JPY' ELSE devise END AS currency, count(*) AS n FROM ({_FX}) GROUP BY 1")
def f24(w):
    return _fx_raw(w).groupBy(IN.currency_code(F.col("devise")).alias("currency")).agg(F.count("*").alias("n"))


@query("P31_price_history", """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close, CASE WHEN l_discount < 0.05 THEN l_extendedprice END AS open,
 l_quantity * 1000 AS volume, l_discount * 100 AS change_pct FROM lineitem""", rounded="close open volume change_pct")
def p31(w):
    price = F.translate(F.expr("format_number(l_extendedprice, '#,##0.00')"), ".,", ",.")
    raw = w.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("date"),
        price.alias("close"), F.when(F.col("l_discount") < 0.05, price).otherwise("-").alias("open"), price.alias("high"), price.alias("low"),
        F.concat(F.expr("format_number(l_quantity, '0')"), F.lit("K")).alias("volume"),
        F.concat(F.expr("format_number(l_discount * 100, '0')"), F.lit(",00%")).alias("change_pct"),
    )
    return IN.clean_price_history(raw).select("ticker", "date", "close", "open", "volume", "change_pct")


@query("P32_company_master", r"""WITH m AS (SELECT c.ticker, max(d) AS detail_ord FROM (SELECT d.detail_ord AS d, min(c.ord) AS c FROM (SELECT item_id AS detail_ord, regexp_extract(text, '^(\S+\s+\S+)', 1) AS detail_name FROM benchmark) d
 JOIN v_doc_companies c ON contains(lower(c.company_name), lower(d.detail_name)) OR contains(lower(d.detail_name), lower(c.company_name)) GROUP BY 1) x JOIN v_doc_companies c ON c.ord = x.c GROUP BY c.ticker)
SELECT c.ticker, c.company_name, coalesce(CASE WHEN m.detail_ord % 3 = 0 THEN 'D' || m.detail_ord END, CASE WHEN c.ord % 5 <> 0 THEN 'R' || c.ord END) AS sector, 'P' || m.detail_ord AS parent,
 CASE WHEN c.ord % 2 = 0 THEN CAST(1900 + c.ord AS INTEGER) END AS founded, 'Seat ' || c.ord AS siege_social FROM v_doc_companies c LEFT JOIN m ON m.ticker = c.ticker""")
def p32(w):
    base = w.doc_companies
    item = F.col("item_id")
    details = w.table("benchmark").select(
        item.alias("detail_ord"), F.regexp_extract("text", r"^(\S+\s+\S+)", 1).alias("detail_name"),
        F.when(item % 3 == 0, F.concat(F.lit("D"), item.cast("string"))).alias("sector"), F.concat(F.lit("P"), item.cast("string")).alias("parent"),
    )
    order = F.col("ord")
    registry = base.select(
        "ticker", F.concat(F.lit("Seat "), order.cast("string")).alias("siege_social"),
        F.when(order % 5 != 0, F.concat(F.lit("MASI R"), order.cast("string"))).otherwise("MASI ").alias("secteur"),
    )
    research = base.select(
        "ticker", F.when(order % 2 == 0, (order + 1900).cast("string")).otherwise("unknown").alias("founded"),
        *[F.lit(None).cast("string").alias(c) for c in IN.RESEARCH_COLUMNS if c != "founded"],
    )
    return IN.build_companies(base, details, registry, research).select(
        "ticker", "company_name", "sector", "parent", "founded", "siege_social"
    )



