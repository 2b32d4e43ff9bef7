"""Registered queries: sources, sinks, upserts, projections, filters, joins, dedup."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom import schemas

from tickerloom.functions import labels as LB

from tickerloom.operators import daily as D
from tickerloom.operators import entities as E
from tickerloom.operators import keyed as KY
from tickerloom.operators import market as MK
from tickerloom.operators import quantiles as Q
from tickerloom.operators.harvest import capture_index, url_filter
from tickerloom.operators.intake import valid_analyses
from tickerloom.operators.paging import paged_list
from tickerloom.plans import dashboards as DB
from tickerloom.plans.catalog import query
from tickerloom.plans.gold import refresh_gold
from tickerloom.session import work_folder
from tickerloom.sources import files, sinks, silver
from tickerloom.sources.keyed_table import KeyedTable
from tickerloom.sources.upsert import append_or_replace, insert_ignore, upsert
from tickerloom.sources.warehouse import ORDER_RULES

# --- sources and sinks -------------------------------------------------------------------


@query("S1_text_csv_scan", """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier""")
def s1(w):
    path = work_folder(w.spark, "csv")
    w.table("supplier").select(
        F.col("s_suppkey").alias(" s_suppkey "), F.col("s_name").alias("s_name "), F.col("s_nationkey").alias(" s_nationkey")
    ).write.option("header", True).csv(path)
    return files.read_text_csv(w.spark, path)


@query("S2_file_name_key", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'P' || p_partkey END AS file_ticker FROM part""")
def s2(w):
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("P"), "p_partkey", F.lit(" - "), "p_name", F.lit(".csv")))
    name = name.otherwise(F.concat(F.lit("notes "), "p_name", F.lit(".csv")))
    path = F.concat(F.lit("file:/data/history/"), F.replace(name, F.lit(" "), F.lit("%20")))
    return w.table("part").select("p_partkey", files.file_key(path).alias("file_ticker"))


@query("S2_multi_file_csv", """SELECT 'B' || substr(asset_key, 7) AS ticker, date, close, CAST(round(close * 10) AS DOUBLE) * 1000 AS volume
FROM v_commodities WHERE asset_key <> 'Brand#11'""", rounded="close volume", digits=4)
def s2_files(w):
    """Price files of the brands, one without a code in its name, and rows without a date, read back in one scan."""
    code = F.concat(F.lit("B"), F.substring("asset_key", 7, 10))
    name = F.when(F.col("asset_key") == "Brand#11", F.lit("notes.csv")).otherwise(F.concat(code, F.lit(" - history.csv")))
    quotes = w.commodities.unionByName(w.commodities.withColumn("date", F.lit(None).cast("date")).dropDuplicates(["asset_key"]))
    day = F.when(F.day("date") % 2 == 0, F.date_format("date", "dd/MM/yyyy")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    close = F.format_number("close", 9)
    rows = quotes.select(
        name.alias("file"), day.alias("Date "), F.replace(close, F.lit(","), F.lit("")).alias("Dernier"), F.lit(None).cast("string").alias("Ouv."),
        F.lit(None).cast("string").alias("Plus Haut"), F.lit(None).cast("string").alias("Plus Bas"),
        F.concat(F.round(F.col("close") * 10).cast("long").cast("string"), F.lit("K")).alias("Vol."), F.lit("0").alias("Variation %"))
    folder = work_folder(w.spark, "history")
    files.write_named_csv(rows, folder, "file")
    return files.read_price_files(w.spark, f"{folder}/*.csv").select("ticker", "date", "close", "volume")


@query("S3_json_scan", "SELECT p_partkey, p_name, p_brand FROM part")
def s3(w):
    path = work_folder(w.spark, "json")
    rows = w.table("part").select("p_partkey", "p_name", "p_brand")
    rows.write.json(path)
    return w.spark.read.schema(rows.schema).json(path)


@query("S4_pruned_parquet_scan", "SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_quantity > 25")
def s4(w):
    return files.read_parquet(w.spark, f"{w.folder}/lineitem.parquet").where("l_quantity > 25").select("l_orderkey", "l_suppkey")


@query("S5_checked_scan", "SELECT count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders")
def s5(w):
    orders = files.require_rows(files.read_parquet(w.spark, f"{w.folder}/orders.parquet"), "orders")
    return orders.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


def _sentiment(w):
    return w.articles.where("sentiment IS NOT NULL").select(
        F.col("url").alias("article_url"), "sentiment", "score", "confidence"
    )


@query("S6_article_extract", """SELECT url, title, CAST(published_at AS DATE) AS day, sentiment, score, confidence
FROM v_articles WHERE published_at IS NOT NULL""", rounded="score confidence")
def s6(w):
    stored = w.articles.drop("sentiment", "score", "confidence")
    return silver.article_extract(stored, _sentiment(w)).select(
        "url", "title", F.to_date("published_at").alias("day"), "sentiment", "score", "confidence"
    )


@query("S6_event_extract", """SELECT e.fingerprint, e.event_type, e.event_date, e.article_count, c.ticker
FROM v_events e LEFT JOIN v_event_companies c ON c.event_fingerprint = e.fingerprint""")
def s6_events(w):
    return silver.event_extract(w.events, w.event_companies).drop("first_seen")


@query("S7_page_scan", """SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS domain, count(*) AS pages,
count(*) FILTER (WHERE html IS NULL OR html = '') AS skipped, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1""")
def s7(w):
    unreadable = F.coalesce(F.col("html"), F.lit("")) == ""
    return w.table("pages").groupBy(F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("domain")).agg(
        F.count("*").alias("pages"), F.count_if(unreadable).alias("skipped"), F.sum(F.length("html")).alias("chars")
    )


@query("S7_archived_pages", """SELECT substr(raw_html_path, 1, 11) AS month, count(*) AS pages, CAST(sum(length(html)) AS BIGINT) AS chars, bit_xor(CAST('0x' || substr(md5(html), 1, 8) AS BIGINT)) AS digest
FROM (SELECT DISTINCT c.raw_html_path, p.html FROM v_captures c JOIN pages p USING (page_id) WHERE c.raw_html_path IS NOT NULL) GROUP BY 1""")
def s7_files(w):
    folder = work_folder(w.spark, "archive")
    pages = w.captures.select("page_id", "raw_html_path").join(w.table("pages").select("page_id", "html"), "page_id")
    files.write_archived_pages(pages, folder).write.format("noop").mode("overwrite").save()
    read = files.read_archived_pages(w.spark, folder)
    digest = F.conv(F.substring(F.md5("html"), 1, 8), 16, 10).cast("long")
    return read.groupBy(F.substring("raw_html_path", 1, 11).alias("month")).agg(
        F.count("*").alias("pages"), F.sum(F.length("html")).alias("chars"), F.bit_xor(digest).alias("digest"))


@query("S8_parquet_round_trip", """SELECT url, capture_timestamp, raw_html_path, digest, CAST(status AS INTEGER) AS status, mimetype, CAST(length AS BIGINT) AS length FROM v_captures""")
def s8(w):
    path = work_folder(w.spark, "captures")
    sinks.write_table(sinks.typed(w.captures, schemas.CAPTURES), path)
    return files.read_parquet(w.spark, path, schema=schemas.CAPTURES).drop("original_published_date")


@query("S9_gold_refresh", """SELECT 'company_dim' AS table_name, count(*) AS n FROM v_dim UNION ALL
SELECT 'event_facts', count(*) FROM v_facts UNION ALL SELECT 'event_company_bridge', count(*) FROM v_bridge UNION ALL
SELECT 'daily_signals', count(*) FROM v_returns UNION ALL SELECT 'sentiment_weekly', count(*) FROM v_weekly UNION ALL
SELECT 'sentiment_monthly', count(*) FROM v_monthly UNION ALL SELECT 'commodity_daily', count(*) FROM v_commodities""")
def s9(w):
    counts = [gold.agg(F.lit(n).alias("table_name"), F.count("*").alias("n")) for n, gold in _gold(w).items()]
    return reduce(DataFrame.unionByName, counts)


def _gold(w):
    """The gold tables after a refresh, as readers see them; one refresh a session and folder."""
    def refresh(folder):
        refresh_gold(
            folder, work_folder(w.spark, "gold-work"), articles=w.articles, companies=w.companies, mentions=w.mentions,
            article_events=w.article_events, prices=w.prices, events=w.events, event_companies=w.event_companies,
            commodities=w.commodities, rules=ORDER_RULES, parts=w.ticker_parts,
        )

    folder = w.once_in("gold", refresh)
    return {name: sinks.gold_table(w.spark, folder, name) for name in schemas.GOLD}


_GOLD_VIEWS = {
    "company_dim": "v_dim", "event_facts": "v_facts", "event_company_bridge": "v_bridge", "daily_signals": "v_signals",
    "sentiment_weekly": "v_weekly", "sentiment_monthly": "v_monthly", "commodity_daily": "v_commodity_daily",
}
# columns that the test data has no source for
_GOLD_EMPTY = {"ceo", "founded", "headquarters", "revenue", "employees", "first_seen"}
_SQL_TYPES = {"string": "VARCHAR", "date": "DATE", "int": "INTEGER", "smallint": "SMALLINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


def _gold_values(name):
    """Every stored value of a gold table but decimals, which round by engine, and columns without a source."""
    fields = [f for f in schemas.GOLD[name] if f.dataType.simpleString() in _SQL_TYPES and f.name not in _GOLD_EMPTY]
    doubles = [f.name for f in fields if f.dataType.simpleString() == "double"]
    columns = ", ".join(f"CAST({f.name} AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}" for f in fields)

    @query(f"S9_{name}", f"SELECT {columns} FROM {_GOLD_VIEWS[name]}", rounded=" ".join(doubles))
    def values(w):
        return _gold(w)[name].select(*[f.name for f in fields])


for _name in schemas.GOLD:
    _gold_values(_name)


@query("S10_typed_signals", """SELECT ticker, date, CAST(direction AS SMALLINT) AS direction, has_news, CAST(news_count AS SMALLINT) AS news_count,
CAST(news_count_r3d AS DECIMAL(8, 4)) AS news_count_r3d FROM v_signals""", rounded="news_count_r3d")
def s10(w):
    return sinks.typed(w.signals, schemas.GOLD["daily_signals"]).select(
        "ticker", "date", "direction", "has_news", "news_count", "news_count_r3d"
    )


def _merged(target, updates, keys, combine):
    """The table that ``target`` is after a write of ``updates``, as readers see it."""
    table = KeyedTable.create(target, work_folder(target.sparkSession, "keyed"), keys, 32)
    table.merge(updates, combine)
    return table.read()


_SPLIT, _OVERLAP = datetime.date(1999, 1, 1), datetime.date(1998, 1, 1)


@query("S11_upsert_newest", """SELECT coalesce(u.ticker, t.ticker) AS ticker, coalesce(u.date, t.date) AS date,
  CASE WHEN u.ticker IS NOT NULL THEN u.close ELSE t.close END AS close, CASE WHEN u.ticker IS NOT NULL THEN u.volume ELSE t.volume END AS volume
FROM (SELECT * FROM v_base_prices WHERE date < DATE '1999-01-01') t
FULL JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
             arg_max({'c': l_extendedprice / l_quantity, 'v': l_quantity}, {'k': l_orderkey * 100 + l_linenumber, 'c': l_extendedprice / l_quantity, 'v': l_quantity}).c AS close,
             arg_max({'c': l_extendedprice / l_quantity, 'v': l_quantity}, {'k': l_orderkey * 100 + l_linenumber, 'c': l_extendedprice / l_quantity, 'v': l_quantity}).v AS volume
           FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '1998-01-01' GROUP BY 1, 2) u ON u.ticker = t.ticker AND u.date = t.date""", rounded="close volume")
def s11(w):
    target = w.base_prices.where(F.col("date") < _SPLIT).select("ticker", "date", "close", "volume")
    rows = w.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"), F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"), F.col("l_quantity").alias("volume"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"),
    ).where(F.col("date") >= _OVERLAP)
    newest = [F.desc("seq"), F.desc("close"), F.desc("volume")]
    return _merged(target, rows, ["ticker", "date"], lambda old, new: upsert(old, new, ["ticker", "date"], newest=newest))


def _event_batches(w):
    old = w.article_events.where(F.col("event_date") < datetime.date(1998, 1, 3))
    new = w.article_events.where(F.col("event_date") >= _OVERLAP)

    def table(df):
        return df.groupBy("fingerprint").agg(
            F.min("event_type").alias("event_type"), F.max("event_date").alias("event_date"),
            F.min(F.to_date("analyzed_at")).alias("first_seen"), F.count("*").alias("article_count"),
        )

    return table(old), table(new)


_EVENT_BATCHES = """
o AS (SELECT fingerprint, min(event_type) AS event_type, max(event_date) AS event_date, min(CAST(analyzed_at AS DATE)) AS first_seen, count(*) AS article_count
      FROM v_article_events WHERE event_date < DATE '1998-01-03' GROUP BY 1),
n AS (SELECT fingerprint, min(event_type) AS event_type, max(event_date) AS event_date, min(CAST(analyzed_at AS DATE)) AS first_seen, count(*) AS article_count
      FROM v_article_events WHERE event_date >= DATE '1998-01-01' GROUP BY 1)"""


@query("S12_upsert_partial", f"""SELECT * FROM (WITH {_EVENT_BATCHES} SELECT coalesce(n.fingerprint, o.fingerprint) AS fingerprint,
 CASE WHEN n.fingerprint IS NOT NULL THEN n.event_type ELSE o.event_type END AS event_type,
 CASE WHEN n.fingerprint IS NOT NULL THEN n.event_date ELSE o.event_date END AS event_date,
 CASE WHEN o.fingerprint IS NOT NULL THEN o.first_seen ELSE n.first_seen END AS first_seen,
 CASE WHEN n.fingerprint IS NOT NULL THEN n.article_count ELSE o.article_count END AS article_count
FROM o FULL JOIN n ON n.fingerprint = o.fingerprint)""")
def s12(w):
    old, new = _event_batches(w)
    overwrite = ["event_type", "event_date", "article_count"]
    return _merged(old, new, ["fingerprint"], lambda o, n: upsert(o, n, ["fingerprint"], overwrite=overwrite))


@query("S13_upsert_fill", """SELECT coalesce(u.ticker, t.ticker) AS ticker,
 CASE WHEN u.ticker IS NOT NULL THEN u.company_name ELSE t.company_name END AS company_name,
 coalesce(u.sector, t.sector) AS sector, coalesce(u.parent, t.parent) AS parent
FROM (SELECT ticker, company_name, sector, parent FROM v_companies WHERE sector <> 'NATION_3') t
FULL JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS ticker, upper(s_name) AS company_name,
             CASE WHEN s_acctbal > 0 THEN 'S' || s_nationkey END AS sector, CASE WHEN s_acctbal > 5000 THEN 'rich' END AS parent
           FROM supplier WHERE s_acctbal < 8000) u ON u.ticker = t.ticker""")
def s13(w):
    target = w.companies.where("sector <> 'NATION_3'")
    updates = w.table("supplier").where("s_acctbal < 8000").select(
        F.col("s_suppkey").cast("string").alias("ticker"), F.upper("s_name").alias("company_name"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("S"), "s_nationkey")).alias("sector"),
        F.when(F.col("s_acctbal") > 5000, "rich").alias("parent"),
    )
    return _merged(target, updates, ["ticker"], lambda old, new: upsert(old, new, ["ticker"], fill=["sector", "parent"]))


@query("S14_insert_ignore", "SELECT DISTINCT 'o' || l_orderkey AS article_url, CAST(l_suppkey AS VARCHAR) AS ticker FROM lineitem")
def s14(w):
    rows = w.table("lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("article_url"),
        F.col("l_suppkey").cast("string").alias("ticker"), "l_returnflag",
    )
    stored = rows.where("l_returnflag = 'A'").drop("l_returnflag").distinct()
    keys = ["article_url", "ticker"]
    return _merged(stored, rows.where("l_returnflag <> 'A'").drop("l_returnflag"), keys, lambda old, new: insert_ignore(old, new, keys))


@query("S15_append_or_replace", """SELECT asset_key, date, CASE WHEN date >= DATE '2000-01-01' THEN close * 2 ELSE close END AS close FROM v_commodities""", rounded="close")
def s15(w):
    quotes = w.commodities.select("asset_key", "date", "close")
    stored = quotes.where(F.col("date") < F.lit("2000-06-01").cast("date"))
    fresh = quotes.where(F.col("date") >= F.lit("2000-01-01").cast("date")).withColumn("close", F.col("close") * 2)
    keys = ["asset_key", "date"]
    return _merged(stored, fresh, keys, lambda old, new: append_or_replace(old, new, keys))


@query("S16_unstored_only", """SELECT url FROM v_articles WHERE url NOT IN (SELECT article_url FROM v_article_events)""")
def s16(w):
    return KY.unknown_only(w.articles, "url", w.article_events, "article_url").select("url")


@query("S17_reject_split", """SELECT coalesce(reason, 'written') AS outcome, count(*) AS n FROM (
 SELECT CASE WHEN l_discount NOT BETWEEN 0 AND 0.09 THEN 'discount' WHEN l_quantity < 2 THEN 'quantity' WHEN l_returnflag NOT IN ('A', 'R') THEN 'flag' END AS reason FROM lineitem) GROUP BY 1""")
def s17(w):
    valid, rejected = sinks.split_valid(w.table("lineitem"), {
        "discount": F.col("l_discount").between(0, 0.09), "quantity": F.col("l_quantity") >= 2,
        "flag": F.col("l_returnflag").isin("A", "R"),
    })
    both = valid.select(F.lit("written").alias("outcome")).unionByName(rejected.select(F.col("reject_reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count("*").alias("n"))


@query("N1_measured_write", """SELECT unnest(['read', 'kept', 'rejected_discount', 'rejected_quantity']) AS metric_name, unnest([count(*), count(*) FILTER (WHERE d AND q), count(*) FILTER (WHERE NOT d), count(*) FILTER (WHERE d AND NOT q)])::DOUBLE AS metric_value
FROM (SELECT coalesce(l_discount BETWEEN 0 AND 0.05, false) AS d, coalesce(l_quantity >= 10, false) AS q FROM lineitem)""")
def n1_measured(w):
    rules = {"discount": F.col("l_discount").between(0, 0.05), "quantity": F.col("l_quantity") >= 10}
    events = sinks.write_measured(w.table("lineitem"), rules, work_folder(w.spark, "measured"), "r1")
    return events.select("metric_name", "metric_value")


@query("S18_known_keys_only", """SELECT ticker, count(*) AS n FROM v_base_prices WHERE ticker IN (SELECT ticker FROM v_companies WHERE parent = 'ASIA') GROUP BY ticker""")
def s18(w):
    asia = w.companies.where("parent = 'ASIA'")
    return KY.known_only(w.base_prices, "ticker", asia, "ticker").groupBy("ticker").agg(F.count("*").alias("n"))


@query("S19_object_layout", r"""SELECT page_id, year, filename, 'ammc/' || year || '/' || filename AS object_name FROM (
 SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '2023' WHEN page_id % 3 = 1 THEN '2024' ELSE 'unknown' END AS year,
   coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^https?://[^/]+.*/([^/]+)$', 1), ''), 'file') AS filename FROM pages)""")
def s19(w):
    page = F.col("page_id")
    text = F.when(page % 3 == 0, "05/11/2023").when(page % 3 == 1, "2024-02-03").otherwise("soon")
    items = w.table("pages").select("page_id", F.col("url").alias("file_url"), text.alias("date"))
    return sinks.object_layout(items, "file_url", "date").select("page_id", "year", "filename", "object_name")


# --- projections and filters -------------------------------------------------------------


@query("B1_project_rename", "SELECT l_orderkey AS order_id, l_suppkey AS ticker, l_quantity AS volume FROM lineitem")
def b1(w):
    return w.table("lineitem").withColumnsRenamed(
        {"l_orderkey": "order_id", "l_suppkey": "ticker", "l_quantity": "volume"}
    ).select("order_id", "ticker", "volume")


@query("B2_not_null", "SELECT url, score FROM v_articles WHERE sentiment IS NOT NULL", rounded="score")
def b2(w):
    return w.articles.dropna(subset=["sentiment"]).select("url", "score")


@query("B3_optional_equal", """SELECT 'All' AS choice, count(*) AS n FROM v_events UNION ALL SELECT 'ma_deal', count(*) FROM v_events WHERE event_type = 'ma_deal'""")
def b3(w):
    def count(choice):
        return KY.optional_equal(w.events, "event_type", choice).agg(F.lit(choice).alias("choice"), F.count("*").alias("n"))

    return count("All").unionByName(count("ma_deal"))


@query("B4_since_last_date", """SELECT ticker, date, volume FROM v_base_prices WHERE date >= (SELECT max(date) FROM v_base_prices) - 90""")
def b4(w):
    return KY.since_last_date(w.base_prices, 90).select("ticker", "date", "volume")


_AS_OF = "2024-01-20 12:00:00"


@query("B5_since_now", "SELECT id, level FROM v_log WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 1 DAY")
def b5(w):
    return KY.since(w.log, "ts", _AS_OF, days=1).select("id", "level")


@query("B6_recency_cut", "SELECT id FROM v_log WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY")
def b6(w):
    return KY.since(w.log, "ts", _AS_OF, days=7).select("id")


@query("B7_url_filter", r"""SELECT url FROM pages WHERE regexp_matches(url, '/(en|fr)/') AND NOT regexp_matches(url, '[?]page=|utm_source')""")
def b7(w):
    return w.table("pages").where(url_filter(F.col("url"), "/(en|fr)/", r"[?]page=|utm_source")).select("url")


@query("B8_membership", "SELECT id, level FROM v_log WHERE level IN ('warning', 'error')")
def b8(w):
    return w.log.where(F.col("level").isin("warning", "error")).select("id", "level")


@query("B9_successful_captures", "SELECT url FROM v_captures WHERE status = 200 AND coalesce(raw_html_path, '') <> ''")
def b9(w):
    return w.captures.where("status = 200 AND coalesce(raw_html_path, '') <> ''").select("url")


@query("B10_quantile_trim", """SELECT ticker, date, next_day_return FROM v_returns WHERE next_day_return
BETWEEN (SELECT quantile_cont(next_day_return, 0.01) FROM v_returns) AND (SELECT quantile_cont(next_day_return, 0.99) FROM v_returns)""", rounded="next_day_return")
def b10(w):
    returns = D.add_returns(w.base_prices).select("ticker", "date", "next_day_return")
    return Q.trim_between_quantiles(returns, "next_day_return")


_RECORDS = """SELECT url, coalesce(sentiment, 'mixed') AS sentiment, score * 1.2 AS score, confidence * 1.05 AS confidence FROM v_articles"""


@query("B11_validated_records", f"""SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n FROM (
 SELECT CASE WHEN sentiment NOT IN ('positive', 'negative', 'neutral') THEN 'sentiment' WHEN NOT coalesce(score BETWEEN -1 AND 1, false) THEN 'score'
   WHEN NOT coalesce(confidence BETWEEN 0 AND 1, false) THEN 'confidence' END AS reason FROM ({_RECORDS})) GROUP BY 1""")
def b11(w):
    records = w.articles.select(
        "url", F.coalesce("sentiment", F.lit("mixed")).alias("sentiment"), (F.col("score") * 1.2).alias("score"),
        (F.col("confidence") * 1.05).alias("confidence"), F.lit("other").alias("event_type"),
    )
    valid, rejected = valid_analyses(records)
    both = valid.select(F.lit("ok").alias("outcome")).unionByName(rejected.select(F.col("reject_reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count("*").alias("n"))


@query("B12_min_history", """SELECT ticker, count(*) AS n, count(balance) AS valid FROM (
 SELECT CAST(c_nationkey AS VARCHAR) AS ticker, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, count(*) OVER (PARTITION BY c_nationkey) AS h FROM customer) WHERE h >= 60 GROUP BY 1""")
def b12(w):
    rows = w.table("customer").select(
        F.col("c_nationkey").cast("string").alias("ticker"), LB.null_if_negative(F.col("c_acctbal")).alias("balance")
    )
    return D.min_history(rows, "ticker", 60).groupBy("ticker").agg(F.count("*").alias("n"), F.count("balance").alias("valid"))


@query("B13_clip", "SELECT ticker, date, CASE WHEN next_day_return IS NOT NULL THEN greatest(least(next_day_return, 0.1), -0.1) END AS clipped FROM v_returns", rounded="clipped")
def b13(w):
    return D.add_returns(w.base_prices).select("ticker", "date", LB.clip(F.col("next_day_return"), -0.1, 0.1).alias("clipped"))


@query("B14_source_tag", """SELECT url, CASE WHEN sentiment IS NOT NULL THEN 'llm' ELSE 'lexicon' END AS sentiment_source, 'orders' AS origin FROM v_articles""")
def b14(w):
    return w.articles.select(
        "url", F.when(F.col("sentiment").isNotNull(), "llm").otherwise("lexicon").alias("sentiment_source"), F.lit("orders").alias("origin")
    )


# --- joins -------------------------------------------------------------------------------


@query("C1_inner_join", "SELECT a.url, m.ticker, a.score FROM v_articles a JOIN v_mentions m ON m.article_url = a.url", rounded="score")
def c1(w):
    return w.articles.join(w.mentions.withColumnRenamed("article_url", "url"), "url").select("url", "ticker", "score")


@query("C2_left_join", """SELECT c.ticker, c.sector, n.news FROM v_companies c LEFT JOIN (SELECT ticker, count(*) AS news FROM v_mentions GROUP BY ticker HAVING count(*) > 590) n ON n.ticker = c.ticker""")
def c2(w):
    news = w.mentions.groupBy("ticker").agg(F.count("*").alias("news")).where("news > 590")
    return w.companies.select("ticker", "sector").join(news, "ticker", "left")


@query("C3_left_join_zero_fill", """SELECT p.ticker, p.date, coalesce(f.news_count, 0) AS news_count, coalesce(f.avg_sentiment, 0) AS avg_sentiment
FROM v_base_prices p LEFT JOIN v_daily f ON f.ticker = p.ticker AND f.date = p.date""", rounded="avg_sentiment")
def c3(w):
    daily = D.daily_features(w.enriched).select("ticker", "date", "news_count", "avg_sentiment")
    return w.base_prices.select("ticker", "date").join(daily, ["ticker", "date"], "left").fillna(0, ["news_count", "avg_sentiment"])


@query("C4_left_anti", "SELECT url FROM v_articles WHERE url NOT IN (SELECT article_url FROM v_mentions)")
def c4(w):
    return KY.unknown_only(w.articles, "url", w.mentions, "article_url").select("url")


@query("C5_left_semi", "SELECT article_url, ticker FROM v_mentions WHERE ticker IN (SELECT ticker FROM v_companies WHERE parent = 'EUROPE')")
def c5(w):
    return KY.known_only(w.mentions, "ticker", w.companies.where("parent = 'EUROPE'"), "ticker").select("article_url", "ticker")


@query("C6_text_contains_name", """SELECT a.url, c.ticker FROM v_doc_articles a JOIN v_doc_companies c
ON contains(lower(concat_ws(' ', a.title, a.full_text)), lower(c.company_name)) WHERE c.company_name <> ''""")
def c6(w):
    texts = w.doc_articles.select("url", F.concat_ws(" ", "title", "full_text").alias("text"))
    return E.containment_join(texts, "url", "text", w.doc_companies.select("ticker", "company_name"), "company_name").select("url", "ticker")


_DETAILS = r"""SELECT item_id AS detail_ord, CASE WHEN item_id % 2 = 0 THEN regexp_extract(text, '^(\S+\s+\S+)', 1) ELSE text END AS detail_name FROM benchmark"""


@query("C7_containment_either_way", f"""SELECT c.ticker, max(d) AS detail_ord FROM (
 SELECT d.detail_ord AS d, min(c.ord) AS c FROM ({_DETAILS}) d JOIN v_doc_companies c
   ON contains(lower(c.company_name), lower(d.detail_name)) OR contains(lower(d.detail_name), lower(c.company_name)) GROUP BY 1) m
JOIN v_doc_companies c ON c.ord = m.c GROUP BY c.ticker""")
def c7(w):
    item, text = F.col("item_id"), F.col("text")
    details = w.table("benchmark").select(
        item.alias("detail_ord"),
        F.when(item % 2 == 0, F.regexp_extract(text, r"^(\S+\s+\S+)", 1)).otherwise(text).alias("detail_name"),
    )
    return E.assign_details(w.doc_companies, details, "ord", "detail_ord")


_TOKENS = r"list_distinct(list_filter(string_split_regex(lower(strip_accents({})), '[^\p{{L}}\p{{N}}_]+'), lambda t: length(t) >= {}))"
_ART_TOKENS = f"SELECT url, {_TOKENS.format('full_text', 1)} AS words FROM v_doc_articles"


@query("C8_token_subset", f"""SELECT DISTINCT a.url, c.ticker FROM ({_ART_TOKENS}) a
JOIN (SELECT ticker, {_TOKENS.format('company_name', 2)} AS need FROM v_doc_companies WHERE length(company_name) > 3
      UNION ALL SELECT ticker, [lower(ticker)] FROM v_doc_companies) c ON len(need) > 0 AND list_has_all(a.words, c.need)""")
def c8(w):
    found = E.match_article_entities(w.doc_articles, w.doc_companies, text="full_text")
    return found.select("url", F.explode("tickers").alias("ticker"))


@query("C9_token_overlap", f"""SELECT DISTINCT a.url, s.sector FROM ({_ART_TOKENS}) a
JOIN (SELECT sector, {_TOKENS.format('sector', 3)} AS need FROM (SELECT DISTINCT trim(regexp_replace(sector, '^MASI\\s+', '')) AS sector FROM v_doc_companies)) s
ON len(need) > 0 AND len(list_intersect(a.words, s.need)) * 1.0 / len(s.need) >= 0.4""")
def c9(w):
    found = E.match_article_entities(w.doc_articles, w.doc_companies, text="full_text")
    return found.select("url", F.explode("sectors").alias("sector"))


@query("C10_matched_only", f"""SELECT DISTINCT a.url FROM ({_ART_TOKENS}) a
JOIN (SELECT {_TOKENS.format('company_name', 2)} AS need, 1.0 AS part FROM v_doc_companies WHERE length(company_name) > 3
      UNION ALL SELECT [lower(ticker)], 1.0 FROM v_doc_companies
      UNION ALL SELECT {_TOKENS.format("regexp_replace(sector, '^MASI ', '')", 3)}, 0.4 FROM v_doc_companies) c
ON len(need) > 0 AND len(list_intersect(a.words, c.need)) * 1.0 / len(c.need) >= part""")
def c10(w):
    found = E.match_article_entities(w.doc_articles, w.doc_companies, text="full_text", require_match=True)
    return found.select("url")


_KEYWORDS = r"""SELECT keyword, coalesce(arg_max(ticker, {'o': ord, 's': step}) FILTER (WHERE step < 3), arg_min(ticker, ord)) AS ticker FROM (
 SELECT lower(ticker) AS keyword, ticker, ord, 1 AS step FROM v_doc_companies
 UNION ALL SELECT lower(company_name), ticker, ord, 2 FROM v_doc_companies
 UNION ALL SELECT unnest(list_filter(string_split_regex(lower(company_name), '[\s\-/&()'']+'), lambda x: length(x) > 4)), ticker, ord, 3 FROM v_doc_companies) GROUP BY keyword"""


@query("C11_keyword_index", f"""SELECT DISTINCT a.url, k.ticker FROM v_doc_articles a JOIN ({_KEYWORDS}) k ON contains(lower(a.full_text), k.keyword)""")
def c11(w):
    index = E.keyword_index(w.doc_companies, "ord")
    return E.match_keywords(w.doc_articles, "url", "full_text", index)


@query("C12_lookup_first_value", """SELECT a.url, e.event_type AS llm_event_type FROM v_articles a
LEFT JOIN (SELECT article_url, min(event_type) AS event_type FROM v_article_events GROUP BY 1) e ON e.article_url = a.url""")
def c12(w):
    return KY.add_first_value(w.articles.select("url"), "url", w.article_events, "article_url", "event_type", "llm_event_type")


BRANDS = [f"Brand#{i}" for i in range(1, 26)]
_PIVOT = ", ".join(f"round(max(close) FILTER (WHERE asset_key = '{b}'), 9) AS \"{b}\"" for b in BRANDS)


@query("C13_outer_align", f"SELECT date, {_PIVOT} FROM v_commodities GROUP BY date", rounded="")
def c13(w):
    wide = MK.wide_closes(w.commodities.withColumn("close", F.round("close", 9)), BRANDS)
    return wide


PAGE = 40   # tickers to a page of the queries


def paged_sql(rows: str, key: str, item: str) -> str:
    """Pages of the distinct items of a key, as comma-separated text."""
    return f"""SELECT {key}, CAST(page AS INTEGER) AS page, string_agg({item}, ',' ORDER BY {item}) AS items
 FROM (SELECT {key}, {item}, (row_number() OVER (PARTITION BY {key} ORDER BY {item}) - 1) // {PAGE} AS page FROM (SELECT DISTINCT {key}, {item} FROM {rows} WHERE {item} IS NOT NULL)) GROUP BY {key}, page"""


@query("C14_optional_collect", f"""SELECT e.fingerprint, e.event_type, coalesce(t.page, 0) AS page, coalesce(t.items, '') AS tickers
FROM v_events e LEFT JOIN ({paged_sql('v_event_companies', 'event_fingerprint', 'ticker')}) t ON t.event_fingerprint = e.fingerprint""")
def c14(w):
    bridge = w.event_companies.withColumnRenamed("event_fingerprint", "fingerprint")
    pages = DB.event_ticker_pages(w.events.select("fingerprint", "event_type"), bridge, PAGE)
    return pages.withColumn("tickers", F.array_join("tickers", ","))


@query("C15_split_explode_join", """SELECT b.fingerprint, b.ticker, c.sector FROM v_bridge b LEFT JOIN v_companies c ON c.ticker = b.ticker""")
def c15(w):
    rows = paged_list(w.event_tables[1], "fingerprint", "ticker", PAGE).select("fingerprint", F.explode("items").alias("ticker"))
    return rows.join(w.companies.select("ticker", "sector"), "ticker", "left")


# Articles are dated at midnight; a shift by the order number puts some after the close.
_STAMPED = "SELECT url, published_at + (CAST(substr(url, 2) AS BIGINT) % 24) * INTERVAL 1 HOUR AS published_at FROM v_articles"
_EVENT_DAY = """SELECT s.url, m.ticker, CAST(timezone('Africa/Casablanca', timezone('UTC', s.published_at)) AS DATE)
   + CASE WHEN CAST(timezone('Africa/Casablanca', timezone('UTC', s.published_at)) AS TIME) > TIME '15:30:00' THEN 1 ELSE 0 END AS day
 FROM ({}) s JOIN v_mentions m ON m.article_url = s.url"""
EVENT_DAYS_SQL = _EVENT_DAY.format(_STAMPED)


def event_days(w):
    shift = F.make_dt_interval(hours=(F.substring("url", 2, 20).cast("long") % 24).cast("int"))
    stamped = w.articles.select("url", (F.col("published_at") + shift).alias("published_at"), "sentiment", "score")
    return stamped.select("url", MK.event_day(F.col("published_at")).alias("day"), "sentiment", "score").join(
        w.mentions.withColumnRenamed("article_url", "url"), "url"
    )


@query("C16_next_session", f"""SELECT e.url, e.ticker, e.day, p.date AS session FROM ({EVENT_DAYS_SQL}) e
ASOF LEFT JOIN (SELECT ticker, date FROM v_base_prices) p ON p.ticker = e.ticker AND e.day <= p.date""")
def c16(w):
    return MK.next_session(event_days(w).select("url", "ticker", "day"), "day", w.base_prices)


@query("C17_rows_around", f"""WITH i AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS idx FROM v_base_prices),
e AS (SELECT e.url, e.ticker, p.date AS session, p.idx FROM ({EVENT_DAYS_SQL}) e ASOF JOIN i p ON p.ticker = e.ticker AND e.day <= p.date)
SELECT e.url, e.ticker, e.session, i.idx - e.idx AS "offset", i.date AS offset_date, i.close FROM e JOIN i ON i.ticker = e.ticker AND i.idx BETWEEN e.idx - 1 AND e.idx + 3""", rounded="close")
def c17(w):
    placed = MK.next_session(event_days(w).select("url", "ticker", "day"), "day", w.base_prices).drop("day")
    return MK.rows_around(placed.where("session IS NOT NULL"), "session", w.base_prices.select("ticker", "date", "close")).withColumn(
        "offset", F.col("offset").cast("long")
    )


@query("C18_within_span", """SELECT fingerprint, event_date FROM v_events WHERE event_date BETWEEN
(SELECT min(date) FROM v_base_prices WHERE ticker = '7') AND (SELECT max(date) FROM v_base_prices WHERE ticker = '7')""")
def c18(w):
    return KY.within_span(w.events, "event_date", w.base_prices.where("ticker = '7'"), "date").select("fingerprint", "event_date")


@query("C19_fan_out", """SELECT e.article_url, v.fingerprint, v.event_type, a.score FROM v_article_events e JOIN v_events v ON v.fingerprint = e.fingerprint
JOIN v_articles a ON a.url = e.article_url WHERE a.sentiment IS NOT NULL""", rounded="score")
def c19(w):
    covers = w.article_events.select("article_url", F.col("fingerprint").alias("event_fingerprint"))
    return silver.scored_events(covers, w.events, _sentiment(w)).select("article_url", "fingerprint", "event_type", "score")


@query("C19_one_per_article", """SELECT e.article_url, min(v.event_type) AS event_type, min(a.score) AS score FROM v_article_events e
JOIN v_events v ON v.fingerprint = e.fingerprint JOIN v_articles a ON a.url = e.article_url WHERE a.sentiment IS NOT NULL GROUP BY 1""", rounded="score")
def c19_one(w):
    covers = w.article_events.select("article_url", F.col("fingerprint").alias("event_fingerprint"))
    return silver.one_per_article(silver.scored_events(covers, w.events, _sentiment(w))).select("article_url", "event_type", "score")


# --- sorts, limits, set operations -------------------------------------------------------


@query("K1_order_by", "SELECT ticker, date, close FROM v_base_prices ORDER BY ticker, date DESC", rounded="close")
def k1(w):
    return w.base_prices.select("ticker", "date", "close").orderBy("ticker", F.desc("date"))


@query("K2_nulls_last", "SELECT c.ticker, n.news FROM v_companies c LEFT JOIN (SELECT ticker, count(*) AS news FROM v_mentions GROUP BY ticker HAVING count(*) > 590) n USING (ticker) ORDER BY news DESC NULLS LAST, ticker")
def k2(w):
    news = w.mentions.groupBy("ticker").agg(F.count("*").alias("news")).where("news > 590")
    return w.companies.select("ticker").join(news, "ticker", "left").orderBy(F.desc_nulls_last("news"), "ticker")


@query("K3_order_limit", "SELECT id, level, metric_value FROM v_log ORDER BY id DESC LIMIT 50", rounded="metric_value")
def k3(w):
    return w.log.select("id", "level", "metric_value").orderBy(F.desc("id")).limit(50)


@query("K5_top_groups_rows", """SELECT e.ticker, e.llm_event_type, count(*) AS n FROM v_enriched e WHERE llm_event_type IS NOT NULL AND ticker IN (
 SELECT ticker FROM v_enriched WHERE llm_event_type IS NOT NULL GROUP BY ticker ORDER BY count(*) DESC, ticker LIMIT 15) GROUP BY 1, 2""")
def k5(w):
    typed = w.enriched.where("llm_event_type IS NOT NULL").groupBy("ticker", "llm_event_type").agg(F.count("*").alias("n"))
    top = typed.groupBy("ticker").agg(F.sum("n").alias("t")).orderBy(F.desc("t"), "ticker").limit(15)
    return typed.join(top.select("ticker"), "ticker", "left_semi")


@query("K7_arg_max", "SELECT ticker, count(*) AS n FROM v_mentions GROUP BY ticker ORDER BY n DESC, ticker LIMIT 1")
def k7(w):
    return w.mentions.groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(1)


@query("K8_capped_run", "SELECT CAST(least(200, count(*)) AS INTEGER) AS n FROM pages")
def k8(w):
    return w.captures.limit(200).agg(F.count("*").cast("int").alias("n"))


@query("U1_union_missing_columns", """SELECT 'stored' AS source, url, ticker, score FROM (SELECT a.url, m.ticker, a.score FROM v_articles a JOIN v_mentions m ON m.article_url = a.url)
UNION ALL SELECT 'event', article_url, NULL, NULL FROM v_article_events""", rounded="score")
def u1(w):
    stored = w.articles.join(w.mentions.withColumnRenamed("article_url", "url"), "url").select(F.lit("stored").alias("source"), "url", "ticker", "score")
    other = w.article_events.select(F.lit("event").alias("source"), F.col("article_url").alias("url"))
    return stored.unionByName(other, allowMissingColumns=True)


@query("U2_grouped_instead_of_union", "SELECT ticker, count(*) AS n, min(date) AS first_date FROM v_base_prices GROUP BY ticker")
def u2(w):
    return w.base_prices.groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first_date"))


@query("U3_distinct", "SELECT DISTINCT ticker, date FROM v_enriched")
def u3(w):
    return w.enriched.select("ticker", "date").distinct()


@query("U4_first_source_wins", """SELECT user_id, event_type, id FROM (SELECT user_id, event_type, event_id AS id,
 row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_id) AS rn FROM events) WHERE rn = 1""")
def u4(w):
    rank = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    rows = w.table("events").select("user_id", "event_type", F.col("event_id").alias("id"), rank.alias("src"))
    return KY.dedup_by_source_order(rows, "user_id", "src", "id").drop("src")


@query("U5_capture_dedup", "SELECT DISTINCT url, capture_timestamp FROM v_captures")
def u5(w):
    both = w.captures.unionByName(w.captures)
    return both.dropDuplicates(["url", "capture_timestamp"]).select("url", "capture_timestamp")


@query("U6_union_of_matches", "SELECT url FROM v_articles WHERE sentiment = 'positive' UNION SELECT article_url FROM v_article_events WHERE event_type = 'ma_deal'")
def u6(w):
    a = w.articles.where("sentiment = 'positive'").select("url")
    b = w.article_events.where("event_type = 'ma_deal'").select(F.col("article_url").alias("url"))
    return a.union(b).distinct()


@query("U7_intersect_except", """SELECT 'both' AS part, count(*) AS n FROM (SELECT url FROM v_articles WHERE sentiment = 'positive' INTERSECT SELECT article_url FROM v_article_events)
UNION ALL SELECT 'only', count(*) FROM (SELECT url FROM v_articles WHERE sentiment = 'positive' EXCEPT SELECT article_url FROM v_article_events)""")
def u7(w):
    a = w.articles.where("sentiment = 'positive'").select("url")
    b = w.article_events.select(F.col("article_url").alias("url"))

    def count(part, df):
        return df.agg(F.lit(part).alias("part"), F.count("*").alias("n"))

    return count("both", a.intersect(b)).unionByName(count("only", a.subtract(b)))


@query("U8_fact_and_bridge", "SELECT 'fact' AS part, fingerprint, NULL AS ticker FROM v_facts UNION ALL SELECT 'bridge', fingerprint, ticker FROM v_bridge")
def u8(w):
    facts, bridge = w.event_tables
    return facts.select(F.lit("fact").alias("part"), "fingerprint", F.lit(None).cast("string").alias("ticker")).unionByName(
        bridge.select(F.lit("bridge").alias("part"), "fingerprint", "ticker")
    )


@query("N5_capture_index", r"""SELECT DISTINCT url, capture_timestamp, digest FROM v_captures WHERE status = 200 AND mimetype = 'text/html' AND NOT regexp_matches(url, '[?]page=')""")
def n5(w):
    return capture_index(w.captures, exclude=r"[?]page=").select("url", "capture_timestamp", "digest")


@query("E7_latest_per_key", "SELECT ticker, date, close FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM v_base_prices) WHERE rn = 1", rounded="close")
def e7(w):
    return KY.latest_per_key(w.base_prices.select("ticker", "date", "close"), "ticker", "date")


@query("E8_best_capture", """SELECT domain, url, capture_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY domain
 ORDER BY (original_published_date IS NOT NULL) DESC, capture_timestamp DESC, digest) AS rn FROM v_captures WHERE status = 200 AND coalesce(raw_html_path, '') <> '') WHERE rn = 1""")
def e8(w):
    by_site = w.captures.withColumn("page", F.col("url")).withColumn("url", F.col("domain"))
    return KY.best_capture(by_site).select("domain", F.col("page").alias("url"), "capture_timestamp")


@query("E9_keep_first_last", """SELECT user_id, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY user_id""")
def e9(w):
    rows = w.table("events").select("user_id", F.col("event_id").alias("id"))
    first = KY.first_per_key(rows, "user_id", F.asc("id")).withColumnRenamed("id", "first_id")
    last = KY.first_per_key(rows, "user_id", F.desc("id")).withColumnRenamed("id", "last_id")
    return first.join(last, "user_id")



