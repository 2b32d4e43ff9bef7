"""Folding texts, and the words of texts that any entry asks for."""

from pyspark.sql import functions as F

from tickerloom.functions import text as TX
from tickerloom.operators import entities as E


def test_every_code_point_folds_as_by_rule(spark):
    codes = [c for c in [*range(1, 0x3100), 0xAC00, 0xFB01, 0xFF21, 0x1D400, 0x1F600] if not 0xD800 <= c < 0xE000]
    texts = [f"aB{chr(c)}É" for c in codes] + ["", "Plain ASCII", "Été", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.f for r in rows.select("i", TX.fold_text(F.col("t")).alias("f")).collect()}
    wrong = [t for i, t in enumerate(texts) if got[i] != (None if t is None else TX._fold(t))]
    # the JVM and Python lower a few letters of newer alphabets differently; those stay as they were
    assert all(TX._fold_table()[2].find(t[2]) >= 0 for t in wrong) and len(wrong) < 10


def test_folding_looks_for_hard_characters_without_a_pattern(spark):
    rows = spark.range(1).select(F.lit("x").alias("t")).select(TX.fold_text(F.col("t")))
    assert "RLIKE" not in rows._jdf.queryExecution().optimizedPlan().toString().upper()
    assert "RLIKE" not in rows._jdf.queryExecution().analyzed().toString().upper()


def test_articles_are_read_once_for_all_entries(spark, monkeypatch):
    kept, stored = [], E.stored
    monkeypatch.setattr(E, "stored", lambda df, label: kept.append((label, stored(df, label))) or kept[-1][1])
    articles = spark.createDataFrame([("1", "Alpha Béta gamma " + "noise " * 50), ("2", "delta alpha"), ("1", "delta"), ("3", None), (None, "alpha beta")], "url string, text string")
    companies = spark.createDataFrame([("T1", "Alpha Beta", "MASI Gamma Delta Eps"), ("T2", "Delta Alpha", None)], "ticker string, company_name string, sector string")
    found = E.match_article_entities(articles, companies, require_match=True)
    # rows that share a key are one text
    assert {(r.url, tuple(r.tickers), tuple(r.sectors)) for r in found.collect()} == {("1", ("T1", "T2"), ("Gamma Delta Eps",)), ("2", ("T2",), ())}
    (label, words), = kept
    assert label == "known-words" and {r[0][0] for r in words.select("_words").collect()} == {"alpha", "beta", "gamma", "delta"}
    assert all("/known-words-" in f for f in found.inputFiles())
    one = E.match_article_entities(articles.where("url = '3'"), companies).collect()
    assert [(r.url, r.tickers, r.sectors) for r in one] == [("3", [], [])]
