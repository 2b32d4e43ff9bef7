"""The warehouse tables as SQL, for checking query results with another engine."""

from tickerloom.constants import EVENT_TYPES, ROLL_BASE, ROLL_WINDOWS, TYPE_FLAGS

TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in EVENT_TYPES) + "]"

# Lexicon score of an order title under ORDER_RULES.
_URGENT = "(CASE WHEN contains(lower(title), 'urgent') OR contains(lower(title), 'high') THEN 1 ELSE 0 END)"
_LOW = "(CASE WHEN contains(lower(title), 'low') THEN 1 ELSE 0 END)"


def _one_hots(value: str) -> str:
    return ", ".join(f"CASE WHEN {value} = '{t}' THEN 1 ELSE 0 END AS llm_evt_{t}" for t in EVENT_TYPES)


def _type_sums() -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in TYPE_FLAGS)


def rolling(columns, key="ticker", order="date") -> str:
    return ", ".join(
        f"avg({c}) OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS {c}_r{w}d"
        for w in ROLL_WINDOWS for c in columns
    )


ROLLED = [f"{c}_r{w}d" for w in ROLL_WINDOWS for c in [*ROLL_BASE, *TYPE_FLAGS]]
FEATURE_COLUMNS = [
    "news_count", "avg_sentiment", "std_sentiment", "positive_count", "negative_count", "event_ma", "event_earnings",
    "event_management", "event_legal", "negated_count", "speculative_count", *TYPE_FLAGS, "positive_ratio",
    "negative_ratio", *ROLLED,
]


def period_sql(label: str, step: str, out: str) -> str:
    sums = ["news_count", "event_ma", "event_earnings", "event_management", "event_legal", *TYPE_FLAGS]
    means = ["avg_sentiment", "std_sentiment", "positive_ratio", "negative_ratio"]
    return f"""
SELECT g.ticker, g.p AS {out},
       {', '.join(f'CAST(coalesce(a.{c}, 0) AS BIGINT) AS {c}' for c in sums)},
       {', '.join(f'a.{c}' for c in means)}
FROM (SELECT ticker, CAST(unnest(generate_series(min(k), max(k), INTERVAL {step})) AS DATE) AS p
      FROM (SELECT ticker, CAST({label} AS DATE) AS k FROM v_features) GROUP BY ticker) g
LEFT JOIN (SELECT ticker, CAST({label} AS DATE) AS k,
                  {', '.join(f'sum({c}) AS {c}' for c in sums)}, {', '.join(f'avg({c}) AS {c}' for c in means)}
           FROM v_features GROUP BY 1, 2) a ON a.ticker = g.ticker AND a.k = g.p"""


VIEWS: dict[str, str] = {
    "v_companies": """SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS company_name, n_name AS sector, r_name AS parent
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "v_articles": """SELECT 'o' || o_orderkey AS url, o_orderpriority AS title, CAST(NULL AS VARCHAR) AS full_text,
  o_orderdate AS published_at, o_orderpriority AS feed_url,
  CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'negative' END AS sentiment,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 201 - 100 AS DOUBLE) / 100 END AS score,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 101 AS DOUBLE) / 100 END AS confidence
FROM orders""",
    "v_mentions": """SELECT DISTINCT 'o' || l_orderkey AS article_url, CAST(l_suppkey AS VARCHAR) AS ticker FROM lineitem""",
    "v_base_prices": """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
  arg_min(l_extendedprice / l_quantity, {'k': l_orderkey * 100 + l_linenumber, 'p': l_extendedprice / l_quantity}) AS open,
  max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
  arg_max(l_extendedprice / l_quantity, {'k': l_orderkey * 100 + l_linenumber, 'p': l_extendedprice / l_quantity}) AS close,
  sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2""",
    "v_prices": """SELECT *, (close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1) * 100 AS change_pct
FROM v_base_prices""",
    "v_article_events": f"""SELECT * FROM (SELECT 'o' || o_orderkey AS article_url, {TYPE_LIST}[o_orderkey % 13 + 1] AS event_type,
  CAST(o_orderdate AS DATE) AS event_date,
  {TYPE_LIST}[o_orderkey % 13 + 1] || '::' || CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS fingerprint,
  o_orderdate AS analyzed_at
FROM orders) WHERE event_type <> 'other'""",
    "v_events": """SELECT fingerprint, min(event_type) AS event_type, min(event_date) AS event_date,
  min(analyzed_at) AS first_seen, count(*) AS article_count FROM v_article_events GROUP BY fingerprint""",
    "v_event_companies": """SELECT DISTINCT e.fingerprint AS event_fingerprint, m.ticker
FROM v_article_events e JOIN v_mentions m USING (article_url)""",
    "v_commodities": """SELECT p_brand AS asset_key, CAST(l_shipdate AS DATE) AS date, p_brand AS name, 'commodity' AS category,
  avg(l_extendedprice / l_quantity) AS close FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand, CAST(l_shipdate AS DATE)""",
    "v_feeds": """SELECT DISTINCT o_orderpriority AS url, 'Feed ' || o_orderpriority AS name, 'fr' AS language FROM orders""",
    "v_log": """SELECT event_id AS id, ts, 'p' || (user_id % 5) AS pipeline_name,
  'p' || (user_id % 5) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || (hour(ts) % 4) AS run_id,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warning' ELSE 'info' END AS level,
  event_type AS metric_name, value AS metric_value FROM events""",
    "v_runs": """SELECT run_id, pipeline_name, min(ts) AS started_at, max(ts) AS ended_at,
  CASE WHEN count(*) FILTER (WHERE level = 'error') > count(*) / 4.0 THEN 'failed' ELSE 'success' END AS status,
  count(*) AS rows_processed, count(*) FILTER (WHERE level = 'error') AS rows_failed
FROM v_log GROUP BY run_id, pipeline_name""",
    "v_doc_articles": """SELECT 'd' || d.doc_id AS url, source AS title, text AS full_text,
  TIMESTAMP '2024-01-01 00:00:00' + d.doc_id * INTERVAL 1 HOUR AS published_at, lang AS language, source AS feed_url,
  CASE WHEN toxic = 1 THEN 'neutral' WHEN quality = 1 THEN 'positive' WHEN quality = 0 THEN 'negative' END AS sentiment,
  CAST(quality - toxic AS DOUBLE) AS score, CASE WHEN quality IS NOT NULL THEN 1.0::DOUBLE END AS confidence
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "v_doc_companies": r"""SELECT 'B' || item_id AS ticker, regexp_extract(text, '^(\S+\s+\S+\s+\S+)', 1) AS company_name,
  'MASI ' || regexp_extract(text, '(\S+\s+\S+\s+\S+\s+\S+)\s*$', 1) AS sector, item_id AS ord FROM benchmark""",
    "v_doc_mentions": """SELECT 'd' || doc_id AS article_url, 'B' || (doc_id % 40) AS ticker FROM labels WHERE toxic = 1""",
    "v_doc_events": f"""SELECT 'd' || doc_id AS article_url, {TYPE_LIST}[doc_id % 13 + 1] AS event_type FROM labels""",
    "v_captures": r"""SELECT url, stamp AS capture_timestamp,
  CASE WHEN page_id % 4 = 0 THEN CAST(day - 3 AS TIMESTAMP) END AS original_published_date,
  CASE WHEN page_id % 3 <> 0 THEN 'raw/' || substr(stamp, 1, 4) || '/' || substr(stamp, 5, 2) || '/' || md5(html) || '.html.gz' END AS raw_html_path,
  md5(html) AS digest, CASE WHEN page_id % 10 = 9 THEN 404 ELSE 200 END AS status, 'text/html' AS mimetype,
  length(html) AS length, regexp_extract(url, '^https?://([^/?#]+)', 1) AS domain, page_id
FROM (SELECT *, DATE '2021-01-01' + CAST(page_id % 900 AS INTEGER) AS day,
             strftime(DATE '2021-01-01' + CAST(page_id % 900 AS INTEGER), '%Y%m%d') || lpad(CAST(page_id % 24 AS VARCHAR), 2, '0') || '3015' AS stamp
      FROM pages)""",
    "v_enriched": f"""SELECT m.url, m.ticker, m.date, m.published_at, m.title, t.llm_event_type,
  CASE WHEN m.sentiment IS NOT NULL THEN m.sentiment WHEN p + n = 0 THEN 'neutral'
       WHEN (p - n) * 1.0 / (p + n) > 0.1 THEN 'positive' WHEN (p - n) * 1.0 / (p + n) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment,
  CASE WHEN m.sentiment IS NOT NULL THEN coalesce(m.score, 0) WHEN p + n = 0 THEN 0.0 ELSE (p - n) * 1.0 / (p + n) END AS score,
  CASE WHEN m.sentiment IS NOT NULL THEN 'llm' ELSE 'lexicon' END AS sentiment_source,
  CAST(contains(title, 'URGENT') AS INTEGER) AS event_ma, CAST(contains(title, 'HIGH') AS INTEGER) AS event_earnings,
  CAST(contains(title, 'MEDIUM') AS INTEGER) AS event_management, CAST(contains(title, 'LOW') AS INTEGER) AS event_legal,
  CAST(contains(title, 'NOT') AS INTEGER) AS is_negated, CAST(contains(title, 'SPECIFIED') AS INTEGER) AS is_speculative,
  {_one_hots('t.llm_event_type')}
FROM (SELECT a.*, x.ticker, CAST(a.published_at AS DATE) AS date, {_URGENT} AS p, {_LOW} AS n
      FROM v_articles a JOIN v_mentions x ON x.article_url = a.url) m
LEFT JOIN (SELECT article_url, min(event_type) AS llm_event_type FROM v_article_events GROUP BY 1) t ON t.article_url = m.url""",
    "v_daily": f"""SELECT *, positive_count * 1.0 / news_count AS positive_ratio, negative_count * 1.0 / news_count AS negative_ratio
FROM (SELECT ticker, date, count(DISTINCT url) AS news_count,
  CAST(sum(CAST(score AS DECIMAL(20,9))) AS DOUBLE) / nullif(count(score), 0) AS avg_sentiment,
  coalesce(stddev_samp(score), 0) AS std_sentiment,
  CAST(sum(CAST(sentiment = 'positive' AS INTEGER)) AS BIGINT) AS positive_count,
  CAST(sum(CAST(sentiment = 'negative' AS INTEGER)) AS BIGINT) AS negative_count,
  CAST(sum(event_ma) AS BIGINT) AS event_ma, CAST(sum(event_earnings) AS BIGINT) AS event_earnings,
  CAST(sum(event_management) AS BIGINT) AS event_management, CAST(sum(event_legal) AS BIGINT) AS event_legal,
  CAST(sum(is_negated) AS BIGINT) AS negated_count, CAST(sum(is_speculative) AS BIGINT) AS speculative_count,
  {_type_sums()} FROM v_enriched GROUP BY ticker, date)""",
    "v_features": f"SELECT *, {rolling([*ROLL_BASE, *TYPE_FLAGS])} FROM v_daily",
    "v_returns": """SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS daily_return, lead(close) OVER w / nullif(close, 0) - 1 AS next_day_return,
  CASE WHEN lead(close) OVER w / nullif(close, 0) - 1 > 0 THEN 1 ELSE 0 END AS direction
FROM v_prices WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
    "v_signals": f"""SELECT r.*, {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in FEATURE_COLUMNS)},
  coalesce(f.news_count, 0) <> 0 AS has_news
FROM v_returns r LEFT JOIN v_features f ON f.ticker = r.ticker AND f.date = r.date""",
    "v_weekly": period_sql("date + CAST((8 - isodow(date)) % 7 AS INTEGER)", "7 DAY", "week_start"),
    "v_monthly": period_sql("date_trunc('month', date)", "1 MONTH", "month_start"),
    "v_dim": """SELECT c.*, coalesce(s.total_news_count, 0) AS total_news_count, s.avg_sentiment_all_time, s.first_article_date,
  s.last_article_date, t.top_event_type
FROM v_companies c
LEFT JOIN (SELECT ticker, count(DISTINCT url) AS total_news_count, avg(score) AS avg_sentiment_all_time, min(date) AS first_article_date,
                  max(date) AS last_article_date FROM v_enriched GROUP BY ticker) s ON s.ticker = c.ticker
LEFT JOIN (SELECT ticker, llm_event_type AS top_event_type FROM (
             SELECT ticker, llm_event_type, row_number() OVER (PARTITION BY ticker ORDER BY count(*) DESC, llm_event_type) AS rn
             FROM v_enriched WHERE llm_event_type IS NOT NULL GROUP BY ticker, llm_event_type) WHERE rn = 1) t ON t.ticker = c.ticker""",
    "v_facts": "SELECT * FROM v_events",
    "v_bridge": "SELECT DISTINCT event_fingerprint AS fingerprint, ticker FROM v_event_companies",
    "v_commodity_returns": """SELECT *, close / nullif(lag(close) OVER (PARTITION BY asset_key ORDER BY date), 0) - 1 AS daily_return FROM v_commodities""",
    "v_commodity_daily": f"""SELECT asset_key, date, name, category, close, daily_return,
  {', '.join(f"avg(close) OVER (PARTITION BY asset_key ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS close_r{w}d" for w in (3, 7))},
  {', '.join(f"avg(daily_return) OVER (PARTITION BY asset_key ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS return_r{w}d" for w in (3, 7))},
  stddev_samp(daily_return) OVER (PARTITION BY asset_key ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_r7d
FROM v_commodity_returns""",
    "v_labelled": f"""SELECT r.*, {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in FEATURE_COLUMNS)}
FROM v_returns r LEFT JOIN v_features f ON f.ticker = r.ticker AND f.date = r.date WHERE r.next_day_return IS NOT NULL""",
    "v_news_days": """SELECT *, epoch(CAST(date AS TIMESTAMP)) >= (SELECT quantile_cont(epoch(CAST(date AS TIMESTAMP)), 0.8) FROM v_labelled WHERE news_count > 0) AS is_test
FROM v_labelled WHERE news_count > 0""",
    "v_model": """SELECT coalesce(regr_slope(next_day_return, avg_sentiment), 0) AS slope, avg(next_day_return) - coalesce(regr_slope(next_day_return, avg_sentiment), 0) * avg(avg_sentiment) AS intercept,
  avg(avg_sentiment) AS centre, stddev_pop(avg_sentiment) AS spread, sign(round(covar_pop(CAST(direction AS DOUBLE), avg_sentiment), 12)) AS rise
FROM v_news_days WHERE NOT is_test""",
    "v_predictions": """SELECT *, CASE WHEN p_up >= 0.5 THEN 1 ELSE 0 END AS pred_direction FROM (
 SELECT ticker, date, direction, next_day_return, round(greatest(least(0.5 + 0.15 * (coalesce((avg_sentiment - centre) / nullif(spread, 0), 0) * rise), 1), 0), 6) AS p_up,
  round(intercept + slope * avg_sentiment, 6) AS pred_return FROM v_news_days, v_model WHERE is_test)""",
}
