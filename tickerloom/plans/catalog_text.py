"""Registered queries: text and scalar expressions, page fields, graph tables, scorers."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom import constants as K
from tickerloom.constants import EVENT_ALIASES, EVENT_TYPES
from tickerloom.functions import html as HT
from tickerloom.functions import labels as LB
from tickerloom.functions import parse as P
from tickerloom.functions import text as TX
from tickerloom.operators import graph as G
from tickerloom.operators import intake as IN
from tickerloom.operators.scoring import per_group, rows_from, score_by_lexicon, score_with
from tickerloom.plans.catalog import query
from tickerloom.plans.catalog_tables import PAGE, paged_sql
from tickerloom.plans.catalog_gold import LEXICON_CASE, LEXICON_CONF, LEXICON_SCORE, PROSE_FLAGS, _GAP, _NW, lexicon_sql
from tickerloom.sources import files
from tickerloom.sources.warehouse import PROSE_RULES

# --- text --------------------------------------------------------------------------------


@query("F1_joined_text", """SELECT doc_id, length(concat_ws(' ', source, text)) AS chars, md5(concat_ws(' ', source, text)) AS digest FROM documents""")
def f1(w):
    whole = TX.joined_text("source", "text")
    return w.documents.select("doc_id", F.length(whole).alias("chars"), F.md5(whole).alias("digest"))


@query("F2_event_flags", f"SELECT doc_id, event_ma, event_earnings, event_management, event_legal FROM (SELECT doc_id, {PROSE_FLAGS} FROM (SELECT doc_id, text AS t FROM documents))")
def f2(w):
    flags = TX.event_flags(F.col("text"), PROSE_RULES)
    return w.documents.select("doc_id", *[c.alias(n) for n, c in flags.items() if n.startswith("event_")])


@query("F3_negation_speculation", f"SELECT doc_id, is_negated, is_speculative FROM (SELECT doc_id, {PROSE_FLAGS} FROM (SELECT doc_id, text AS t FROM documents))")
def f3(w):
    flags = TX.event_flags(F.col("text"), PROSE_RULES)
    return w.documents.select("doc_id", *[flags[n].alias(n) for n in ("is_negated", "is_speculative")])


@query("F4_lexicon_sentiment", f"SELECT doc_id, {LEXICON_CASE} AS sentiment, {LEXICON_SCORE} AS score, {LEXICON_CONF} AS confidence FROM (SELECT doc_id, {lexicon_sql('text', PROSE_RULES)} FROM documents)", rounded="score confidence")
def f4(w):
    return score_by_lexicon(w.documents, "doc_id", "text", PROSE_RULES)


@query("F4_default_lexicon", f"SELECT doc_id, {LEXICON_CASE} AS sentiment, {LEXICON_SCORE} AS score, {LEXICON_CONF} AS confidence FROM (SELECT doc_id, {lexicon_sql('text', TX.TextRules())} FROM documents)", rounded="score confidence")
def f4_default(w):
    return score_by_lexicon(w.documents, "doc_id", "text")


@query("F5_lexicon_fallback", f"""SELECT url, CASE WHEN sentiment IS NOT NULL THEN sentiment ELSE {LEXICON_CASE} END AS sentiment, CASE WHEN sentiment IS NOT NULL THEN coalesce(score, 0) ELSE {LEXICON_SCORE} END AS score
FROM (SELECT url, sentiment, score, {lexicon_sql('full_text', PROSE_RULES)} FROM v_doc_articles)""", rounded="score")
def f5(w):
    lex = F.when(F.col("sentiment").isNull(), TX.lexicon_sentiment(F.col("full_text"), PROSE_RULES))
    return w.doc_articles.withColumn("lex", lex).select(
        "url", F.coalesce("sentiment", "lex.sentiment").alias("sentiment"),
        F.coalesce(F.when(F.col("sentiment").isNull(), F.col("lex.score")).otherwise(F.col("score")), F.lit(0.0)).alias("score"),
    )


_SPELLINGS = ["Positive", " positif ", "très positif", "négatif fort", "Mitigé", "NEUTRE", "negative", "???"]


@query("F7_sentiment_label", f"""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'positive' WHEN 1 THEN 'positive' WHEN 2 THEN 'positive' WHEN 3 THEN 'negative' WHEN 6 THEN 'negative' ELSE 'neutral' END AS sentiment FROM documents""")
def f7(w):
    raw = F.element_at(F.array(*[F.lit(s) for s in _SPELLINGS]), (F.col("doc_id") % 8 + 1).cast("int"))
    return w.documents.select("doc_id", LB.normalise_sentiment(raw).alias("sentiment"))


@query("F8_event_type", f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ['{"', '".join(EVENT_TYPES)}'][doc_id % 13 + 1] WHEN doc_id % 3 = 1 THEN ['{"', '".join(EVENT_ALIASES.values())}'][doc_id % 19 + 1] ELSE 'other' END AS event_type FROM documents""")
def f8(w):
    doc = F.col("doc_id")

    def pick(words):
        return F.element_at(F.array(*[F.lit(x) for x in words]), (doc % len(words) + 1).cast("int"))

    raw = F.when(doc % 3 == 0, F.concat(F.lit(" "), F.upper(pick(EVENT_TYPES)))).when(
        doc % 3 == 1, F.concat(F.lit("Les "), F.upper(pick(list(EVENT_ALIASES))), F.lit(" 2024"))
    ).otherwise("xyz")
    return w.documents.select("doc_id", LB.normalise_event_type(raw).alias("event_type"))


def _analyses(w):
    """Analysis records of the order articles: tickers, one person, fingerprint."""
    named = w.mentions.groupBy("article_url").agg(F.array_sort(F.collect_set("ticker")).alias("mentioned_tickers"))
    people = w.table("orders").join(w.table("customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("article_url"),
        F.array(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("role"))).alias("mentioned_people"),
        "o_orderdate",
    )
    types = w.article_events.select("article_url", "event_type")
    joined = people.join(named, "article_url").join(types, "article_url", "left").fillna("other", ["event_type"])
    day = F.when(F.dayofmonth("o_orderdate") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon")
    return joined.withColumn(
        "event_fingerprint", LB.fingerprint(F.col("event_type"), F.col("mentioned_tickers"), day, F.col("o_orderdate"))
    )


_PRINTS = """SELECT m.article_url, CASE WHEN e.event_type IS NULL THEN '' ELSE substr(sha256(e.event_type || '::' || m.tickers || '::' || strftime(e.event_date, '%G-W%V')), 1, 16) END AS event_fingerprint
FROM (SELECT article_url, string_agg(ticker, '|' ORDER BY ticker) AS tickers FROM v_mentions GROUP BY 1) m LEFT JOIN v_article_events e ON e.article_url = m.article_url"""


@query("F9_fingerprint", _PRINTS)
def f9(w):
    return _analyses(w).select("article_url", "event_fingerprint")


@query("F10_fold_accents", "SELECT doc_id, md5(lower(strip_accents(text))) AS digest FROM documents")
def f10(w):
    return w.documents.select("doc_id", F.md5(TX.fold_text(F.col("text"))).alias("digest"))


@query("F11_tokens", r"""SELECT doc_id, len(list_distinct(list_filter(string_split_regex(lower(strip_accents(text)), '[^\p{L}\p{N}_]+'), lambda t: t <> ''))) AS tokens FROM documents""")
def f11(w):
    return w.documents.select("doc_id", F.size(TX.tokens(TX.fold_text(F.col("text")))).cast("long").alias("tokens"))


@query("F12_clean_text", r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\s\pZ]+', ' ', 'g'))) AS digest FROM pages""")
def f12(w):
    return w.table("pages").select("page_id", F.md5(TX.clean_text(F.col("html"))).alias("digest"))


@query("F12_strip_markup", r"""SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) - length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&amp;', '&', 'g')) AS saved FROM pages""")
def f12_strip(w):
    bare = F.regexp_replace("html", "<[^>]+>", "")
    return w.table("pages").select("page_id", (F.length(bare) - F.length(F.replace(bare, F.lit("&amp;"), F.lit("&")))).cast("long").alias("saved"))


_ENTITIES = {"&quot;": '"', "&copy;": "©", "&middot;": "·"}
_DECODED = "regexp_replace(html, '<[^>]+>', '', 'g')"
for _entity, _sign in _ENTITIES.items():
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_sign}')"
_DECODED = f"regexp_replace({_DECODED}, '&amp;?', '&', 'g')"


@query("F12_decoded_text", rf"""SELECT page_id, length(t) AS chars, md5(t) AS digest FROM (SELECT page_id, regexp_replace({_DECODED}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g') AS t FROM pages)""")
def f12_decoded(w):
    bare = TX.strip_markup(F.col("html"))
    return w.table("pages").select("page_id", F.length(bare).cast("long").alias("chars"), F.md5(bare).alias("digest"))


# Phrases for the fixed rules: what each pattern means, and the same inside a longer word.
def _phrases():
    plain = [re.sub(r"\[s\]\?|\[e\]\?|s\?", "s", p.replace(r"\b", "")).replace(".{0,25}", " vraiment ").replace(".", "'")
             for p in [*(p for ps in K.EVENT_FAMILIES.values() for p in ps), *K.NEGATION, *K.SPECULATION]]
    return [x for p in plain for x in (p, f"é{p}x", p.upper())]


def _rule_sql(patterns):
    """The patterns with Unicode word borders, for an engine whose own are ASCII."""
    def one(p):
        p = p.lower()
        if ".{0,25}" in p:
            first, second = p.replace(r"\b", "").split(".{0,25}")
            return rf"(^|{_NW}){first}({_GAP}|{_GAP}[^\n]{{0,23}}{_GAP}){second}($|{_NW})"
        return rf"(^|{_NW}){p.replace(chr(92) + 'b', '')}($|{_NW})"

    return "CAST(" + " OR ".join("regexp_matches(lower(t), '" + one(p).replace("'", "''") + "')" for p in patterns) + " AS INTEGER)"


_PHRASES = _phrases()
_PHRASE_SQL = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in _PHRASES) + "]"
_TITLES = f"""SELECT o_orderkey, {_PHRASE_SQL}[o_orderkey % {len(_PHRASES)} + 1] || ' ' || o_orderpriority || ' ' || {_PHRASE_SQL}[o_custkey * 7 % {len(_PHRASES)} + 1] AS t FROM orders"""


@query("F2_fixed_rules", f"""SELECT o_orderkey, {', '.join(f'{_rule_sql(ps)} AS event_{n}' for n, ps in K.EVENT_FAMILIES.items())}, {_rule_sql(K.NEGATION)} AS is_negated, {_rule_sql(K.SPECULATION)} AS is_speculative FROM ({_TITLES})""")
def f2_fixed(w):
    """The fixed rules over titles made of their phrases."""
    def phrase(key):
        return F.element_at(F.array(*[F.lit(p) for p in _PHRASES]), (key % len(_PHRASES) + 1).cast("int"))

    title = F.concat_ws(" ", phrase(F.col("o_orderkey")), "o_orderpriority", phrase(F.col("o_custkey") * 7))
    return w.table("orders").select("o_orderkey", title.alias("t")).select("o_orderkey", *[c.alias(n) for n, c in TX.event_flags(F.col("t")).items()])


@query("F13_parse_volume", "SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, CASE WHEN l_linenumber % 3 = 0 THEN l_quantity * 1000 WHEN l_linenumber % 3 = 1 THEN l_quantity * 1000000 END AS volume FROM lineitem", rounded="volume")
def f13(w):
    q, n = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    text = F.when(n % 3 == 0, F.concat(q, F.lit(",000"))).when(n % 3 == 1, F.concat(q, F.lit(".0M"))).otherwise("x")
    return w.table("lineitem").select(
        F.col("l_orderkey").alias("k"), n.alias("n"), F.col("l_suppkey").alias("s"), P.parse_volume(text).alias("volume")
    )


@query("F14_strip_prefix", "SELECT ticker, nullif(trim(regexp_replace(sector, '^MASI\\s+', '')), '') AS sector FROM v_doc_companies")
def f14(w):
    return w.doc_companies.select("ticker", TX.strip_index_prefix(F.col("sector")).alias("sector"))


@query("F15_first_filled", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS label FROM customer")
def f15(w):
    blank = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("  ")
    return w.table("customer").select("c_custkey", TX.first_filled(blank, F.col("c_name")).alias("label"))


@query("F16_parse_day", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def f16(w):
    key = F.col("o_orderkey") % 3
    text = F.when(key == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(key == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("31/02/2024")
    return w.table("orders").select("o_orderkey", P.parse_day(text, "dd/MM/yyyy", "yyyy-MM-dd").alias("day"))


@query("F17_parse_iso", "SELECT event_id, epoch_ms(date_trunc('second', ts)) // 1000 - CASE WHEN event_id % 4 = 1 THEN 3600 ELSE 0 END AS epoch FROM events")
def f17(w):
    ts, kind = F.col("ts"), F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+0100'"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    )
    return w.table("events").select("event_id", F.unix_timestamp(P.parse_iso(text)).alias("epoch"))


@query("F18_resolve_published", """SELECT page_id, epoch_ms(coalesce(original_published_date, strptime(capture_timestamp, '%Y%m%d%H%M%S'))) // 1000 AS epoch FROM v_captures""")
def f18(w):
    at = P.resolve_published(F.col("original_published_date"), F.col("capture_timestamp"), F.current_timestamp())
    return w.captures.select("page_id", F.unix_timestamp(at).alias("epoch"))


@query("F19_day_of", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def f19(w):
    return w.table("events").select("event_id", P.day_of(F.col("ts").cast("timestamp")).alias("day"))


@query("F20_period_keys", "SELECT event_id, strftime(ts, '%Y-%m') AS month, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y') WHEN 1 THEN strftime(ts, '%Y') ELSE 'unknown' END AS year FROM events")
def f20(w):
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.date_format("ts", "dd/MM/yyyy")).when(kind == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("")
    return w.table("events").select("event_id", F.date_format("ts", "yyyy-MM").alias("month"), P.year_of_text(text).alias("year"))


@query("F21_storage_path", "SELECT page_id, 'raw/' || substr(capture_timestamp, 1, 4) || '/' || substr(capture_timestamp, 5, 2) || '/' || digest || '.html.gz' AS path FROM v_captures")
def f21(w):
    return w.captures.select("page_id", P.storage_path(F.col("capture_timestamp"), F.col("digest")).alias("path"))


@query("F22_last_path_segment", r"SELECT page_id, coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^https?://[^/]+.*/([^/]+)$', 1), ''), 'file') AS name FROM pages")
def f22(w):
    return w.table("pages").select("page_id", P.last_path_segment(F.col("url")).alias("name"))


@query("F26_array_functions", "SELECT article_url, string_agg(ticker, '|' ORDER BY ticker) AS key, count(*) AS n, bool_or(ticker = '7') AS has_seven FROM v_mentions GROUP BY 1")
def f26(w):
    lists = w.mentions.groupBy("article_url").agg(F.collect_list("ticker").alias("t"))
    both = F.concat("t", "t")
    return lists.select(
        "article_url", F.array_join(F.array_sort(F.array_distinct(both)), "|").alias("key"),
        F.size(F.array_distinct(both)).cast("long").alias("n"), F.array_contains("t", "7").alias("has_seven"),
    )


def _dated_pages(w):
    """Test pages carry no date: one of several date notations is added to each head."""
    kind, day = F.col("page_id") % 4, F.date_add(F.lit("2022-01-01").cast("date"), F.col("page_id").cast("int")).cast("string")
    tag = (
        F.when(kind == 0, F.concat(F.lit('<meta content="'), day, F.lit('T08:00:00Z" property="article:published_time">')))
        .when(kind == 1, F.concat(F.lit('<script type="application/ld+json">[{"@type":"X"},{"datePublished":"'), day, F.lit('T10:00:00+02:00"}]</script>')))
        .when(kind == 2, F.concat(F.lit('<script type="application/ld+json">{"dateCreated":"'), day, F.lit('"}</script><time datetime="1999-01-01">')))
        .otherwise(F.concat(F.lit('<meta name="date" content="soon"><time datetime="'), day, F.lit(' 08:00:00">x</time>')))
    )
    return w.table("pages").withColumn("html", F.replace(F.col("html"), F.lit("<head>"), F.concat(F.lit("<head>"), tag)))


_PAGE_TIME = "TIMESTAMP '2022-01-01 00:00:00' + page_id * INTERVAL 1 DAY + CASE WHEN page_id % 4 = 2 THEN INTERVAL 0 HOUR ELSE INTERVAL 8 HOUR END"


@query("F27_linked_data_dates", "SELECT page_id, CASE WHEN page_id % 4 = 1 THEN strftime(DATE '2022-01-01' + CAST(page_id AS INTEGER), '%Y-%m-%d') || 'T10:00:00+02:00' WHEN page_id % 4 = 2 THEN strftime(DATE '2022-01-01' + CAST(page_id AS INTEGER), '%Y-%m-%d') END AS found FROM pages")
def f27(w):
    dates = F.filter(HT.json_ld_dates(F.col("html")), lambda d: d.isNotNull())
    return _dated_pages(w).select("page_id", F.try_element_at(dates, F.lit(1)).alias("found"))


@query("F28_published_time", f"SELECT page_id, epoch_ms({_PAGE_TIME}) // 1000 AS epoch FROM pages")
def f28(w):
    return _dated_pages(w).select("page_id", F.unix_timestamp(HT.published_time(F.col("html"))).alias("epoch"))


@query("F28_page_title", r"""SELECT page_id, replace(replace(replace(replace(trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS title FROM pages""")
def f28_title(w):
    return w.table("pages").select("page_id", HT.page_title(F.col("html")).alias("title"))


@query("F28_page_articles")
def f28_articles(w):
    captures = w.captures.select("url", "capture_timestamp", "original_published_date")
    return IN.page_articles(captures, w.table("pages"), "article", F.lit("2024-01-01").cast("timestamp")).withColumn(
        "published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")
    )


# --- scorers and rows from rows ----------------------------------------------------------


@query("J1_struct_flags", f"SELECT doc_id, event_ma + event_earnings + event_management + event_legal AS families, {LEXICON_CASE} AS sentiment FROM (SELECT doc_id, {PROSE_FLAGS}, {lexicon_sql('t', PROSE_RULES)} FROM (SELECT doc_id, text AS t FROM documents))")
def j1(w):
    flags = TX.event_flags(F.col("text"), PROSE_RULES)
    total = sum((c for n, c in flags.items() if n.startswith("event_")), F.lit(0))
    return w.documents.select("doc_id", total.alias("families"), TX.lexicon_sentiment(F.col("text"), PROSE_RULES)["sentiment"].alias("sentiment"))


def _length_scorer(batch: pd.DataFrame) -> pd.DataFrame:
    words = batch["text"].str.split().str.len()
    return pd.DataFrame({"words": words.astype("int64"), "chars": batch["text"].str.len().astype("int64")})


@query("J3_pluggable_scorer", r"SELECT doc_id, len(list_filter(string_split_regex(text, '[\s\pZ]+'), lambda x: x <> '')) AS words, length(text) AS chars, CAST(NULL AS VARCHAR) AS error FROM documents")
def j3(w):
    schema = T.StructType([T.StructField("words", T.LongType()), T.StructField("chars", T.LongType())])
    return score_with(w.documents.select("doc_id", "text"), _length_scorer, schema, "doc_id")


@query("J4_explode_matches", "SELECT m.article_url, m.ticker, c.c_name AS person FROM v_mentions m JOIN orders o ON m.article_url = 'o' || o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey")
def j4(w):
    rows = _analyses(w).select("article_url", F.explode("mentioned_tickers").alias("ticker"), "mentioned_people")
    return rows.select("article_url", "ticker", F.inline("mentioned_people")).select("article_url", "ticker", F.col("name").alias("person"))


class _Lines:
    """Numbered lines of a text, blank ones left out."""

    def eval(self, text: str):
        for number, line in enumerate((text or "").split("\n"), 1):
            if line.strip(" "):
                yield number, len(line)


@query("J4_rows_from_rows", """SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(length(body) AS INTEGER) AS chars FROM (
 SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents) WHERE trim(body, ' ') <> ''""")
def j4_table_function(w):
    return rows_from(w.documents.select("doc_id", "text"), "text", _Lines, "line int, chars int").drop("text")


def _worst_fall(prices: pd.DataFrame) -> pd.DataFrame:
    closes = prices.sort_values("date")["close"].to_numpy()
    return pd.DataFrame({"days": [len(closes)], "worst_fall": [float((closes / np.maximum.accumulate(closes) - 1).min())]})


@query("J2_per_group", """SELECT ticker, count(*) AS days, min(close / top - 1) AS worst_fall FROM (SELECT ticker, close, max(close) OVER (PARTITION BY ticker ORDER BY date) AS top FROM v_base_prices) GROUP BY ticker""", rounded="worst_fall")
def j2(w):
    return per_group(w.base_prices.select("ticker", "date", "close"), ["ticker"], _worst_fall, "days long, worst_fall double")


@query("J5_configured_fields", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS note FROM events""")
def j5(w):
    schema = files.schema_from_fields([
        {"name": "k", "type": "bigint", "description": "counter"}, {"name": "note", "description": "free text"},
    ])
    return w.table("events").select("event_id", F.from_json("props", schema).alias("f")).select("event_id", "f.k", "f.note")


@query("J6_custom_aggregates", "SELECT ticker, count(*) FILTER (WHERE direction > 0) AS ups, count(*) AS n FROM v_returns GROUP BY 1")
def j6(w):
    from tickerloom.operators.daily import add_returns

    return add_returns(w.base_prices).groupBy("ticker").agg(F.count_if(F.col("direction") > 0).alias("ups"), F.count("*").alias("n"))


# --- graph -------------------------------------------------------------------------------


@query("G1_person_merge", """SELECT coalesce(n.k, o.k) AS normalized_name, coalesce(n.name, o.name) AS name, coalesce(o.role, n.role) AS role FROM
 (SELECT lower(c_name) AS k, c_name AS name, c_mktsegment AS role FROM customer WHERE c_acctbal < 5000) o FULL JOIN
 (SELECT lower(c_name) AS k, upper(c_name) AS name, 'new' AS role FROM customer WHERE c_acctbal > 3000) n ON n.k = o.k""")
def g1(w):
    people = w.table("customer").withColumn("normalized_name", TX.normalized_name(F.col("c_name")))
    nodes = people.where("c_acctbal < 5000").select("normalized_name", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("role"))
    found = people.where("c_acctbal > 3000").select("normalized_name", F.upper("c_name").alias("name"), F.lit("new").alias("role"))
    return G.merge_nodes(nodes, found, "normalized_name", create_only=("role",))


@query("G2_guarded_edges", "SELECT DISTINCT article_url, ticker FROM v_mentions WHERE ticker IN (SELECT ticker FROM v_companies WHERE parent <> 'ASIA') AND article_url IN (SELECT url FROM v_articles WHERE sentiment IS NOT NULL)")
def g2(w):
    return G.edges(
        w.mentions, "article_url", w.articles.where("sentiment IS NOT NULL"), "url",
        "ticker", w.companies.where("parent <> 'ASIA'"), "ticker",
    )


@query("G3_sector_nodes", "SELECT DISTINCT trim(regexp_replace(sector, '^MASI\\s+', '')) AS name FROM v_doc_companies WHERE trim(regexp_replace(sector, '^MASI\\s+', '')) <> ''")
def g3(w):
    return G.sector_nodes(w.doc_companies)


@query("G3_company_sector_edges", "SELECT DISTINCT ticker, trim(regexp_replace(sector, '^MASI\\s+', '')) AS sector FROM v_doc_companies WHERE trim(regexp_replace(sector, '^MASI\\s+', '')) <> ''")
def g3_edges(w):
    return G.company_sector_edges(w.doc_companies)


@query("G4_event_company_edges", f"SELECT DISTINCT p.event_fingerprint, m.ticker FROM ({_PRINTS}) p JOIN v_mentions m ON m.article_url = p.article_url WHERE p.event_fingerprint <> ''")
def g4(w):
    return G.analysis_edges(_analyses(w))["involves"]


@query("G4_person_company_edges", "SELECT DISTINCT lower(c.c_name) AS normalized_name, m.ticker FROM v_mentions m JOIN orders o ON m.article_url = 'o' || o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey")
def g4_people(w):
    return G.analysis_edges(_analyses(w))["associated_with"]


@query("G5_one_hop", "SELECT m.article_url, m.ticker, a.feed_url FROM v_mentions m JOIN v_articles a ON a.url = m.article_url")
def g5(w):
    return G.one_hop(w.mentions, "article_url", w.articles, "url", ["feed_url"])


_PERSON_LINKS = "(SELECT lower(c.c_name) AS normalized_name, m.ticker, m.article_url FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN v_mentions m ON m.article_url = 'o' || o.o_orderkey)"


@query("G6_people_summary", f"""SELECT lower(c.c_name) AS normalized_name, c.c_mktsegment AS role, coalesce(n.article_count, 0) AS article_count, coalesce(t.page, 0) AS page, coalesce(t.items, '') AS associated_tickers
FROM customer c LEFT JOIN (SELECT normalized_name, count(DISTINCT article_url) AS article_count FROM {_PERSON_LINKS} GROUP BY 1) n ON n.normalized_name = lower(c.c_name)
LEFT JOIN ({paged_sql(_PERSON_LINKS, 'normalized_name', 'ticker')}) t ON t.normalized_name = lower(c.c_name)""")
def g6(w):
    links = G.analysis_edges(_analyses(w))
    people = w.table("customer").select(TX.normalized_name(F.col("c_name")).alias("normalized_name"), F.col("c_mktsegment").alias("role"))
    out = G.neighbour_summary(
        people, "normalized_name", links["mentions_person"], "article_url", links["associated_with"], "ticker", "article_count", "associated_tickers", PAGE
    )
    return out.withColumn("associated_tickers", F.array_join("associated_tickers", ","))


@query("G7_set_property", "SELECT ticker, sector, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS balance FROM v_companies JOIN supplier ON CAST(s_suppkey AS VARCHAR) = ticker", rounded="balance")
def g7(w):
    values = w.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("ticker"), F.col("s_acctbal").alias("balance"))
    return G.set_property(w.companies.select("ticker", "sector"), "ticker", values, "balance")


@query("G8_property_coverage", "SELECT count(*) AS total, count(score) AS with_value FROM v_articles")
def g8(w):
    return G.property_coverage(w.articles, "score")


@query("G8_missing_property", "SELECT url FROM v_articles WHERE score IS NULL")
def g8_missing(w):
    return G.missing_property(w.articles, "score").select("url")


@query("G9_articles_naming_both", "SELECT article_url FROM v_mentions WHERE ticker = '7' AND article_url IN (SELECT article_url FROM v_mentions WHERE ticker = '3')")
def g9(w):
    return G.articles_naming_both(w.mentions, "7", "3")


@query("G9_co_mention_partners", "SELECT b.ticker, count(DISTINCT b.article_url) AS articles FROM v_mentions a JOIN v_mentions b ON b.article_url = a.article_url WHERE a.ticker = '7' AND b.ticker <> '7' GROUP BY 1")
def g9_partners(w):
    return G.co_mention_partners(w.mentions, "7")
