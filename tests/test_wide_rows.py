"""Wide daily rows: what is stored, dealt and rounded."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.operators import daily as D
from tickerloom.plans.catalog import TIE_SHIFT, _rounded
from tickerloom.session import WIDE_CONF
from tickerloom.sources.warehouse import Warehouse

from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_signals_are_joined_where_the_windows_left_them(spark):
    w = Warehouse(spark, SF)
    assert all(spark.conf.get(k) == v for k, v in WIDE_CONF.items())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = plan(w.prices).count("Exchange hashpartitioning") + plan(w.features).count("Exchange hashpartitioning")
        text = plan(w.signals)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == own
    stored = {c for c in w.daily.columns if c.endswith(("_r3d", "_r7d"))}
    assert not stored   # trailing means are derived, not written


def test_trailing_means_skip_missing_values(spark):
    rng = random.Random(3)
    rows = [(k, dt.date(2024, 1, d), rng.choice([None, rng.uniform(-1, 1), -0.0, 1e16]), rng.choice([None, rng.randrange(9)]))
            for k in (None, "a", "b") for d in range(1, 25)]
    df = spark.createDataFrame(rows, "k string, d date, x double, n bigint").repartition(5)
    base = W.partitionBy("k").orderBy("d")
    frames = df.select("*", *[F.avg(c).over(base.rowsBetween(1 - n, 0)).alias(f"{c}_r{n}d") for n in (3, 7) for c in "xn"])
    got = D.rolling_mean(df, "k", "d", ["x", "n"], (3, 7))
    assert got.schema == frames.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, frames.collect()))


def test_rounding_is_that_of_round(spark):
    rng = random.Random(5)
    shift = TIE_SHIFT * 1e-6
    values = [rng.uniform(-10, 10) * 10**rng.randrange(-8, 14) for _ in range(3000)]
    values += [k * 1e-6 + 5e-7 - shift for k in range(-300, 300)] + [None, 0.0, -0.0, float("nan"), float("inf"), -float("inf"), 1e300, -1e-9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    plain = F.round(F.col("x") + F.lit(shift), 6)
    want = df.select(F.when(plain == 0, 0.0).otherwise(plain).alias("x"))
    assert list(map(repr, _rounded(df, ["x"], 6).collect())) == list(map(repr, want.collect()))


def test_enriched_rows_and_prices_are_dealt_once(spark):
    w = Warehouse(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(w.daily).count("Exchange hashpartitioning") == plan(w.features).count("Exchange hashpartitioning") == 1
        assert plan(w.prices).count("Exchange hashpartitioning") == 1
        assert plan(w.signals).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_daily_features_count_distinct_articles(spark):
    rows = [("A", 1, "u1", 0.5), ("A", 1, "u1", 0.5), ("A", 1, "u2", None), ("A", 1, None, 1.0), ("A", 1, None, None),
            ("A", 2, None, None), ("B", 1, "u1", -1.0), (None, 1, "u1", 1.0), ("B", None, "u3", 1.0)]
    flags = ["event_ma", "event_earnings", "event_management", "event_legal", "is_negated", "is_speculative"]
    df = spark.createDataFrame(
        [(t, d and dt.date(2024, 1, d), u, s, "positive" if s and s > 0 else None, *[1] * 6) for t, d, u, s in rows],
        "ticker string, date date, url string, score double, sentiment string, " + ", ".join(f"{c} int" for c in flags)).repartition(3)
    for parts in (None, 3):
        daily = D.daily_features(df, type_columns=[], parts=parts)
        got = {(r["ticker"], r["date"].day): (r["news_count"], r["avg_sentiment"], r["positive_count"], r["event_ma"]) for r in daily.collect()}
        assert got == {("A", 1): (2, 2 / 3, 3, 5), ("A", 2): (0, None, 0, 1), ("B", 1): (1, -1.0, 0, 1)}


def test_mapped_articles_take_mentions_or_names(spark):
    articles = spark.createDataFrame(
        [("m", "Acme"), ("n", "Acme and Bolt"), ("n", "Acme and Bolt"), ("z", "none"), (None, "Acme"), ("k", "Bolt")],
        "url string, title string").selectExpr("url", "title", "CAST(NULL AS STRING) full_text", "TIMESTAMP '2024-01-01' published_at")
    companies = spark.createDataFrame([("A", "acme"), ("B", "bolt")], "ticker string, company_name string")
    mentions = spark.createDataFrame([("m", "X"), ("m", "Y"), ("k", None), (None, "Q")], "article_url string, ticker string")
    got = sorted(map(repr, ((r["url"], r["ticker"]) for r in D.map_entities(articles, companies, mentions).collect())))
    assert got == sorted(map(repr, [("m", "X"), ("m", "Y"), ("k", None)] + 4 * [("n", "A"), ("n", "B")]))


def test_typed_zeros_are_those_of_the_cast(spark):
    from tickerloom.sources.sinks import typed

    values = [0.0, -0.0, 1 / 3, 2.00005, -0.00005, 1e-9, 12.5, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    schema = T.StructType([T.StructField("x", T.DecimalType(8, 4))])
    got = typed(df, schema)
    assert got.schema["x"].dataType == schema["x"].dataType
    assert got.collect() == df.select(F.col("x").cast("decimal(8,4)")).collect()
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in text and "0.0000" in text


def test_trend_line_reads_stored_pairs(spark):
    from tickerloom.plans.dashboards import sentiment_trend_line

    pairs = spark.range(200).selectExpr("'T' ticker", "CAST(id % 7 AS DOUBLE) avg_sentiment", "CAST(id AS DOUBLE) next_day_return")
    line = sentiment_trend_line(pairs.unionByName(pairs.where("ticker = 'none'")))
    assert line.inputFiles() and all("/pairs-" in f for f in line.inputFiles())
    assert line.first()["n"] == 196


def test_forests_keep_the_node_of_each_row(spark):
    from tickerloom.operators import learn as L

    rows = L.assemble(spark.range(200).selectExpr("CAST(id % 10 AS DOUBLE) x", "CAST(id % 2 AS INT) direction", "id / 100 next_day_return"), ["x"])
    for model in (L.fit_classifier(rows, trees=2, depth=2), L.fit_regressor(rows, trees=2, depth=2)):
        assert model.getOrDefault("cacheNodeIds") and model.getNumTrees == 2


def test_model_rows_hold_what_their_readers_use(spark):
    from tickerloom.constants import MODEL_FEATURES, TYPE_FLAGS

    columns = Warehouse(spark, SF).news_days.columns
    assert {"ticker", "date", "daily_return", "next_day_return", "direction", "positive_count", "negative_count", *MODEL_FEATURES} == set(columns)
    assert not set(TYPE_FLAGS) & set(columns)


def test_parts_dealt_by_ticker_grow_with_the_lines(spark, monkeypatch):
    from tickerloom.sources import warehouse

    cores = spark.sparkContext.defaultParallelism
    assert Warehouse(spark, SF).ticker_parts == cores
    monkeypatch.setattr(warehouse, "ROWS_PER_PART", 250)
    w = Warehouse(spark, SF)
    parts = -(-w.table("lineitem").count() // 250)
    assert w.ticker_parts == parts > cores
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(w.signals)
        # adaptive execution leaves numbers that were asked for as they are, and the join deals nothing anew
        assert text.count(f", {parts}), REPARTITION_BY_NUM") == text.count("Exchange hashpartitioning") == 2
        assert w.signals.rdd.getNumPartitions() == parts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_forests_learn_from_even_parts(spark):
    from tickerloom.operators import learn as L

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(800).selectExpr("CAST(id % 5 = 0 AS INT) direction").coalesce(1)
    sizes = L.balanced_weights(L.spread(rows), "direction").rdd.glom().map(len).collect()
    assert len(sizes) == cores and sum(sizes) == 800 and max(sizes) - min(sizes) <= 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighted = L.balanced_weights(rows, "direction")
        assert "BroadcastHashJoin" in plan(weighted)     # rows are not dealt by their class
        assert {(r[0], round(r[1], 9)) for r in weighted.distinct().collect()} == {(1, 2.5), (0, 0.625)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_refresh_deals_features_as_the_prices(spark, monkeypatch, tmp_path):
    from tickerloom.plans import gold

    class Seen(Exception):
        pass

    def stop(enriched, parts):
        raise Seen(parts)

    monkeypatch.setattr(gold.D, "daily_features", stop)
    w = Warehouse(spark, SF)
    with pytest.raises(Seen) as seen:
        gold.refresh_gold(
            str(tmp_path / "gold"), str(tmp_path / "work"), articles=w.articles, companies=w.companies, mentions=w.mentions,
            article_events=w.article_events, prices=w.prices, events=w.events, event_companies=w.event_companies, commodities=w.commodities, parts=13)
    assert seen.value.args == (13,)
