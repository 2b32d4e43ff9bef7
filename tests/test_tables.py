"""Upserts, sinks, scorers, streams and plan shapes."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.constants import ROLL_BASE, TYPE_FLAGS
from tickerloom.operators import daily as D
from tickerloom.operators import entities as E
from tickerloom.operators import keyed as KY
from tickerloom.operators import learn as L
from tickerloom.operators import market as MK
from tickerloom.operators.scoring import score_with
from tickerloom.sources import files, sinks
from tickerloom.sources.upsert import insert_ignore, upsert
from tickerloom.sources.warehouse import Warehouse

from tests.conftest import SF


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def old_new(spark):
    schema = "k string, a string, b string"
    old = spark.createDataFrame([("1", "Bank", "x"), ("2", "Oil", None)], schema)
    return old, spark.createDataFrame([("1", None, "X"), ("3", "New", "n")], schema)


def test_upsert_kinds(old_new):
    old, new = old_new
    assert rows(upsert(old, new, ["k"])) == [("1", None, "X"), ("2", "Oil", None), ("3", "New", "n")]
    assert rows(upsert(old, new, ["k"], overwrite=["b"])) == [("1", "Bank", "X"), ("2", "Oil", None), ("3", "New", "n")]
    assert rows(upsert(old, new, ["k"], fill=["a"])) == [("1", "Bank", "X"), ("2", "Oil", None), ("3", "New", "n")]
    assert rows(insert_ignore(old, new, ["k"])) == [("1", "Bank", "x"), ("2", "Oil", None), ("3", "New", "n")]


def test_upsert_is_idempotent(old_new):
    old, new = old_new
    once = upsert(old, new, ["k"], fill=["a"])
    assert rows(upsert(once, new, ["k"], fill=["a"])) == rows(once)


def test_upsert_takes_newest(spark, old_new):
    old, _ = old_new
    many = spark.createDataFrame([("1", "p", "q", 1), ("1", "r", "s", 2)], "k string, a string, b string, seq int")
    assert ("1", "r", "s") in rows(upsert(old, many, ["k"], newest=[F.desc("seq")]))


def test_full_refresh_refuses_unknown_tables(spark, tmp_path):
    one = spark.createDataFrame([("T",)], "ticker string")
    with pytest.raises(ValueError):
        sinks.full_refresh({"nope": one}, str(tmp_path))
    assert sinks.full_refresh({"company_dim": one, "event_facts": one.where("false")}, str(tmp_path)) == ["company_dim"]


def test_price_files(spark, tmp_path):
    (tmp_path / "ATW - history.csv").write_text(
        'Date, Dernier ,Ouv.,Plus Haut,Plus Bas,Vol.,Variation %\n2024-01-02,10.5,10,11,9,"1,2K",0.5\nbad,1,1,1,1,1,1\n'
    )
    (tmp_path / "notes.csv").write_text("Date,Dernier,Ouv.,Plus Haut,Plus Bas,Vol.,Variation %\n2024-01-02,1,1,1,1,1,1\n")
    got = files.read_price_files(spark, str(tmp_path / "*.csv")).collect()
    assert [(r.ticker, r.date, r.close, r.volume) for r in got] == [("ATW", dt.date(2024, 1, 2), 10.5, 12000.0)]


def test_json_array_and_archived_pages(spark, tmp_path):
    import gzip

    (tmp_path / "c.json").write_text('[{"ticker": "A"},\n {"ticker": "B"}]')
    assert files.read_json_array(spark, str(tmp_path / "c.json")).count() == 2
    raw = tmp_path / "pages" / "raw" / "2024" / "01"
    raw.mkdir(parents=True)
    (raw / "a.html.gz").write_bytes(gzip.compress("<p>é</p>".encode()))
    (raw / "b.html.gz").write_bytes(b"broken")
    got = dict(files.read_archived_pages(spark, str(tmp_path / "pages")).collect())
    assert got == {"raw/2024/01/a.html.gz": "<p>é</p>", "raw/2024/01/b.html.gz": None}


def test_scorer_retries_and_reports(spark):
    schema = T.StructType([T.StructField("n", T.LongType())])

    def scorer(batch):
        if (batch["i"] == 3).any():
            raise ValueError("no")
        return pd.DataFrame({"n": batch["i"] * 2})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        df = spark.range(1, 5, numPartitions=1).withColumnRenamed("id", "i")
        got = {r.i: (r.n, r.error) for r in score_with(df, scorer, schema, "i", retries=1, delay=0.0).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {1: (2, None), 2: (4, None), 3: (None, "no"), 4: (8, None)}


def test_time_split_and_quantile(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 5),)], "date date")
    at = df.select(L.cutoff(df).cast("string").alias("t")).first()["t"]
    assert at == "2024-01-04 04:48:00"
    train, test = L.time_split(df)
    assert (train.count(), test.count()) == (1, 1)


def test_drawdown_never_positive(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, i + 1), r) for i, r in enumerate([0.1, -0.2, 0.05, None])], "date date, r double")
    curve = daily.withColumn("cum", MK.cumulative("r"))
    worst = MK.drawdown(curve, "cum").agg(F.max("drawdown"), F.min("drawdown")).first()
    assert worst[0] == 0.0 and abs(worst[1] + 0.2) < 1e-12


def test_rolling_window_of_one_is_identity(spark):
    w = Warehouse(spark, SF)
    daily = D.daily_features(w.enriched).select("ticker", "date", "news_count")
    rolled = D.rolling_mean(daily, "ticker", "date", ["news_count"], [1])
    assert rolled.where("news_count <> news_count_r1d").isEmpty()


def test_weekly_sums_match_daily(spark):
    w = Warehouse(spark, SF)
    daily = D.daily_features(w.enriched)
    weekly = D.weekly(daily)
    assert weekly.agg(F.sum("news_count")).first()[0] == daily.agg(F.sum("news_count")).first()[0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_features_share_one_exchange(spark):
    w = Warehouse(spark, SF)
    daily = w.base_prices.select("ticker", "date", *[F.col("close").alias(c) for c in [*ROLL_BASE, *TYPE_FLAGS]])
    before = plan(daily).count("Exchange hashpartitioning")
    text = plan(D.rolling_mean(daily, "ticker", "date", [*ROLL_BASE, *TYPE_FLAGS]))
    assert text.count("Exchange hashpartitioning") - before == 1 and text.count("Window [") == 1


def test_latest_row_is_limited_before_the_shuffle(spark):
    w = Warehouse(spark, SF)
    text = plan(KY.latest_per_key(w.table("lineitem").select("l_suppkey", "l_shipdate"), "l_suppkey", "l_shipdate"))
    assert "Partial" in text and "WindowGroupLimit" in text


@pytest.mark.parametrize("small_rows", [0, 10_000])
def test_text_match_has_no_nested_loop(spark, small_rows):
    w = Warehouse(spark, SF)
    texts = w.doc_articles.select("url", "full_text")
    text = plan(E.containment_join(texts, "url", "full_text", w.doc_companies, "company_name", small_rows=small_rows))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_filters_reach_the_scan(spark):
    w = Warehouse(spark, SF)
    text = plan(w.table("lineitem").where("l_quantity > 25").select("l_orderkey"))
    assert "GreaterThan(l_quantity,25.0)" in text
