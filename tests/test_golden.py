"""Hand-written rows for semantics that are hard to state in SQL."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tickerloom.functions import html as HT
from tickerloom.functions import labels as LB
from tickerloom.functions import parse as P
from tickerloom.functions import text as TX
from tickerloom.operators import daily as D
from tickerloom.operators import entities as E
from tickerloom.operators import keyed as KY
from tickerloom.operators import market as MK
from tickerloom.operators import quantiles as Q
from tickerloom.operators import stats as ST


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def column(df, name="v"):
    return [r[name] for r in df.orderBy("i").collect()]


def test_lexicon(spark):
    df = texts(spark, ["hausse du bénéfice malgré une baisse", "réunion du conseil", None, "HAUSSE, forte!"])
    rows = column(df.select("i", TX.lexicon_sentiment(F.col("t")).alias("v")))
    assert tuple(rows[0]) == ("positive", 0.333, 1.0)
    assert tuple(rows[1]) == tuple(rows[2]) == ("neutral", 0.0, 0.0)
    assert tuple(rows[3]) == ("positive", 1.0, 1.0)


def test_event_flags_ignore_accented_case(spark):
    df = texts(spark, ["Le PDG est NOMMÉ après la fusion", "la société ne prévoit pas de cession", "bénéfices RÉSULTAT"])
    flags = TX.event_flags(F.col("t"))
    rows = [r.asDict() for r in df.select("i", *[c.alias(n) for n, c in flags.items()]).orderBy("i").collect()]
    assert (rows[0]["event_management"], rows[0]["event_ma"], rows[0]["event_earnings"], rows[0]["event_legal"]) == (1, 1, 0, 0)
    assert (rows[1]["is_negated"], rows[1]["is_speculative"], rows[1]["event_ma"]) == (1, 1, 1)
    assert rows[2]["event_earnings"] == 1


def test_folding_and_tokens(spark):
    df = texts(spark, ["Société Générale", "ﬁnance №5 Ǆ", "ÉLÉGANT, œuvre", "مرحبا"])
    assert column(df.select("i", TX.fold_text(F.col("t")).alias("v"))) == [TX._fold(t) for t in ["Société Générale", "ﬁnance №5 Ǆ", "ÉLÉGANT, œuvre", "مرحبا"]]
    assert set(column(df.select("i", TX.tokens(TX.fold_text(F.col("t"))).alias("v")))[2]) == {"elegant", "œuvre"}


def test_markup(spark):
    df = texts(spark, ["<p>A &amp; B</p> ", "a<br>b\n c", None])
    assert column(df.select("i", TX.strip_markup(F.col("t")).alias("v"))) == ["A & B", "ab\n c", ""]
    assert column(df.select("i", TX.clean_text(F.col("t")).alias("v"))) == ["A &amp; B", "a b c", ""]


def test_labels(spark):
    df = texts(spark, ["Mitigé", "très positif", "négatif fort", "???"])
    assert column(df.select("i", LB.normalise_sentiment(F.col("t")).alias("v"))) == ["neutral", "positive", "negative", "neutral"]
    df = texts(spark, ["Résultats annuels", "fusion-acquisition", "MA_DEAL", "xyz"])
    assert column(df.select("i", LB.normalise_event_type(F.col("t")).alias("v"))) == ["earnings_release", "ma_deal", "ma_deal", "other"]


def test_fingerprint(spark):
    df = spark.createDataFrame(
        [(0, "ma_deal", ["B", "A", "B"], "2024-12-30"), (1, "other", ["A"], None), (2, "ma_deal", None, "bad")],
        "i int, e string, t array<string>, d string",
    )
    published = F.lit("2024-01-02 10:00:00").cast("timestamp")
    got = column(df.select("i", LB.fingerprint(F.col("e"), F.col("t"), F.col("d"), published).alias("v")))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()[:16]
    assert got == [digest("ma_deal::A|B::2025-W01"), "", digest("ma_deal::::2024-W01")]


def test_numbers(spark):
    df = texts(spark, ["1,234", "2.5K", "1.2M", "", "x", "1d", None])
    assert column(df.select("i", P.parse_volume(F.col("t")).alias("v"))) == [1234.0, 2500.0, 1200000.0, None, None, None, None]
    df = texts(spark, ["1.234", "2,5K"])
    assert column(df.select("i", P.parse_volume_local(F.col("t")).alias("v"))) == [1234.0, 2500.0]


def test_week_gaps(spark):
    days = [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-08", 3), ("2024-01-23", 4)]
    df = spark.createDataFrame([("T", dt.date.fromisoformat(d), n, float(n)) for d, n in days], "ticker string, date date, n int, m double")
    out = D.resample(df, "ticker", D.week_label(F.col("date")), "7 days", "week", ["n"], ["m"]).orderBy("week").collect()
    assert [(str(r.week), r.n, r.m) for r in out] == [
        ("2024-01-01", 1, 1.0), ("2024-01-08", 5, 2.5), ("2024-01-15", 0, None), ("2024-01-22", 0, None), ("2024-01-29", 4, 4.0),
    ]


def test_month_gaps(spark):
    df = spark.createDataFrame([("T", dt.date(2024, 1, 31), 1), ("T", dt.date(2024, 4, 1), 2)], "ticker string, date date, n int")
    out = D.resample(df, "ticker", D.month_label(F.col("date")), "1 month", "m", ["n"], []).orderBy("m").collect()
    assert [(str(r.m), r.n) for r in out] == [("2024-01-01", 1), ("2024-02-01", 0), ("2024-03-01", 0), ("2024-04-01", 2)]


def test_direction_and_returns(spark):
    df = spark.createDataFrame([("T", dt.date(2024, 1, i + 1), c) for i, c in enumerate([0.0, 2.0, 1.0])], "ticker string, date date, close double")
    out = D.add_returns(df).orderBy("date").collect()
    assert [r.daily_return for r in out] == [None, None, -0.5]
    assert [r.direction for r in out] == [0, 0, 0]
    assert D.add_returns(df, drop_unlabelled=True).count() == 1


def test_mode_ties(spark):
    df = spark.createDataFrame([("T", c) for c in "cab"] + [("U", "z"), ("U", "z"), ("U", "a")], "k string, v string")
    assert dict(ST.mode_per_key(df, "k", "v", "m").collect()) == {"T": "a", "U": "z"}


def test_quantile_buckets(spark):
    values = [0, 0, 0, 1, 2, 3, 4, 5, 6, 7]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double")
    assert column(Q.quantile_bucket(df, "x", 4), "bucket") == [0, 0, 0, 1, 1, 2, 2, 3, 3, 3]


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles(spark, n):
    import numpy as np

    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.33, 0.0, rng.normal(size=n))   # a third of the rows share one value
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}
    got = Q.exact_quantiles(df, "x", probs).first()
    assert np.allclose([got[k] for k in probs], np.quantile(values, list(probs.values())))


def test_best_capture(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("u", None, "2", 200, "p"), ("u", day, "1", 200, "p"), ("u", day, "3", 200, "p"), ("v", day, "9", 404, "p")]
    df = spark.createDataFrame(
        [(*r, "d") for r in rows],
        "url string, original_published_date timestamp, capture_timestamp string, status int, raw_html_path string, digest string",
    )
    assert [(r.url, r.capture_timestamp) for r in KY.best_capture(df).collect()] == [("u", "3")]


def test_published_time_chain(spark):
    pages = [
        '<meta content="2024-01-02T03:04:05Z" property="article:published_time"><time datetime="1999-01-01">',
        '<script type="application/ld+json">[{"a":1},{"dateCreated":"2024-02-03"}]</script><time datetime="1999-01-01">',
        '<time datetime="2024-03-04 05:06:07">x</time>', "<p>none</p>",
    ]
    got = column(texts(spark, pages).select("i", F.date_format(HT.published_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("v")))
    assert got == ["2024-01-02 03:04:05", "2024-02-03 00:00:00", "2024-03-04 05:06:07", None]


def test_element_text_and_title(spark):
    page = '<html><head><title> A &amp; B </title></head><div class="x body"><p>One</p><p>Two<br>three</p><script>no</script></div><div>out</div>'
    row = texts(spark, [page]).select(HT.element_text(F.col("t"), "div.body").alias("b"), HT.page_title(F.col("t")).alias("v")).first()
    assert (row.b, row.v) == ("One\nTwo\nthree", "A & B")


def test_after_close_is_next_day(spark):
    df = texts(spark, ["2024-01-02 14:29:00", "2024-01-02 14:31:00"])   # one hour behind local time
    got = column(df.select("i", MK.event_day(F.col("t").cast("timestamp")).cast("string").alias("v")))
    assert got == ["2024-01-02", "2024-01-03"]


@pytest.mark.parametrize("small_rows", [0, 1000])
def test_containment_paths_agree(spark, small_rows):
    names = ["Bank of Africa", "bank", "a", "Supplier#1", "Supplier#12", "éclat", "(x)"]
    bodies = ["The BANK OF AFRICA (X)", "Supplier#12 rose", "ÉCLAT", "", None, "embankment", "supplier#"]
    t = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    n = spark.createDataFrame(list(enumerate(names)), "j int, name string")
    got = {(r.k, r.j) for r in E.containment_join(t, "k", "body", n, "name", small_rows=small_rows).collect()}
    assert got == {
        (k, j) for k, b in enumerate(bodies) if b for j, x in enumerate(names) if x.lower() in b.lower()
    }


@pytest.mark.parametrize("small_rows", [0, 1000])
@pytest.mark.parametrize("threshold", [0.4, 1.0])
def test_overlap_paths_agree(spark, small_rows, threshold):
    bags = [["petrole", "gaz"], ["banque", "de", "maroc"], ["gaz"], ["x"]]
    docs = [["gaz", "x", "y"], ["banque", "maroc"], ["banque", "de", "maroc", "petrole"], []]
    t = spark.createDataFrame(list(enumerate(docs)), "k int, words array<string>")
    e = spark.createDataFrame(list(enumerate(bags)), "j int, need array<string>")
    got = {(r.k, r.j) for r in E.overlap_join(t, "k", "words", e, "j", "need", threshold, small_rows).collect()}
    assert got == {
        (k, j) for k, d in enumerate(docs) for j, b in enumerate(bags) if len(set(d) & set(b)) / len(b) >= threshold
    }


@pytest.mark.parametrize("small_rows", [0, 1000])
def test_overlap_ignores_repeats_and_joins_rows_of_a_key(spark, small_rows):
    e = spark.createDataFrame([(1, ["x", "z"]), (2, ["x", "x"])], "j int, need array<string>")
    t = spark.createDataFrame([(1, ["x", "x", "y"]), (2, ["x", "y"]), (2, ["z", "q"])], "k int, words array<string>")
    got = {(r.k, r.j) for r in E.overlap_join(t, "k", "words", e, "j", "need", 1.0, small_rows).collect()}
    assert got == {(1, 2), (2, 1), (2, 2)}


def test_keyword_index_rules(spark):
    df = spark.createDataFrame(
        [(0, "ATW", "Attijari Finance"), (1, "BCP", "Populaire Finance"), (2, "FINANCE", "Groupe Maroc")], "ord int, ticker string, company_name string"
    )
    index = dict(E.keyword_index(df, "ord").collect())
    assert index["finance"] == "FINANCE" and index["attijari"] == "ATW" and index["populaire"] == "BCP"
    assert "groupe" not in index and index["groupe maroc"] == "FINANCE"


def test_detail_assignment(spark):
    companies = spark.createDataFrame([(0, "A", "Alpha Bank"), (1, "B", "Alpha Bank Plus")], "ord int, ticker string, company_name string")
    details = spark.createDataFrame([(0, "alpha"), (1, "Alpha Bank Plus Holding"), (2, "zeta")], "detail_ord int, detail_name string")
    assert E.assign_details(companies, details, "ord", "detail_ord").collect() == [("A", 1)]


def test_meta_values_without_quotes_and_with_the_other_quote(spark):
    pages = ['<meta name=date content=2024-01-02>', """<meta property="og:title" content="it's here">""", "<meta name=dateline content=2024-01-02>"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    assert column(df.select("i", HT._meta_contents(F.col("h"), "name", "date").alias("v"))) == [["2024-01-02"], [], []]
    assert column(df.select("i", HT.page_title(F.col("h")).alias("v")))[1] == "it's here"
