"""Library parts against plain Python on small made-up rows."""

import datetime
import gzip
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tickerloom.operators import entities as E
from tickerloom.operators import learn as L
from tickerloom.operators import quantiles as Q
from tickerloom.operators import stats as ST
from tickerloom.operators.paging import listed, paged_list
from tickerloom.operators.scoring import per_group, rows_from
from tickerloom.schemas import GOLD
from tickerloom.sources import files, sinks, warehouse
from tickerloom.streaming import feed as STREAM

# --- sample sort -------------------------------------------------------------------------


@pytest.mark.parametrize("per_range", [7, 1_000_000])
def test_ranks_and_quantiles_over_ranges(spark, monkeypatch, per_range):
    monkeypatch.setattr(Q, "ROWS_PER_RANGE", per_range)
    rnd = random.Random(1)
    rows = [("hot", float(rnd.randrange(60))) for _ in range(300)] + [(k, rnd.random()) for k in "abc" for _ in range(5)] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r.v): (r.n, r.before, r.total) for r in Q.ranked_values(df, "v", ["k"]).collect()}
    kept = [r for r in rows if None not in r]
    assert got == {(k, v): (kept.count((k, v)), sum(a == k and b < v for a, b in kept), sum(a == k for a, _ in kept)) for k, v in kept}
    middle = {r.k: (r.q1, r.q2) for r in Q.exact_quantiles(df, "v", {"q1": 0.25, "q2": 0.9}, ["k"]).collect()}
    for k in "abc":
        assert middle[k] == pytest.approx(tuple(np.quantile([v for a, v in kept if a == k], [0.25, 0.9])))


def test_ranges_follow_the_data(spark, monkeypatch):
    monkeypatch.setattr(Q, "ROWS_PER_RANGE", 100)
    plan = Q.ranked_values(spark.range(1000).select(F.col("id").alias("v")), "v")
    assert plan.select(F.max("before")).first()[0] == 999
    assert "ranges" in plan._jdf.queryExecution().optimizedPlan().toString() or plan.count() == 1000


# --- correlations ------------------------------------------------------------------------


def test_correlation_pairs_equal_numpy_and_keep_small_pairs(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(1e6, 1, 200)                           # far from zero: sums of squares would swamp it
    y = 0.5 * x + rnd.normal(0, 1, 200)
    z = [None if i % 50 else float(i) for i in range(200)]
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "z": pd.Series(z, dtype="float64"), "c": np.ones(200)})).repartition(5)
    df = df.withColumn("z", F.nanvl("z", F.lit(None)))
    got = {(r.left, r.right): (r.r, r.n) for r in ST.correlation_pairs(df, ["x", "y", "z", "c"], min_rows=31).collect()}
    assert got["x", "y"][0] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9) and got["x", "y"][1] == 200
    assert got["x", "z"] == (None, 4) and got["x", "c"] == (None, 200) and len(got) == 6
    assert all(r.r is None and r.n == 0 for r in ST.correlation_pairs(df.limit(0), ["x", "y"]).collect())


# --- names in texts ----------------------------------------------------------------------


@pytest.mark.parametrize("small_rows", [0, 1000])
def test_containment_equals_brute_force(spark, monkeypatch, small_rows):
    monkeypatch.setattr(E, "BLOCK_BYTES", 64)             # texts longer than a block
    rnd = random.Random(5)
    words = ["bank", "of", "maroc", "éclat", "a", "gaz", "Ü", "字", "x" * 40]
    names = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 4))) for _ in range(60)} | {"ba", "z m", "ank of", ""})
    bodies = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(30))).upper() for _ in range(80)] + ["", None, "BANK" * 100]
    t = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    n = spark.createDataFrame([(j, x) for j, x in enumerate(names)] + [(99, None)], "j int, name string")
    got = sorted((r.k, r.j) for r in E.containment_join(t, "k", "body", n, "name", small_rows=small_rows).collect())
    assert got == sorted((k, j) for k, b in enumerate(bodies) if b for j, x in enumerate(names) if x and x.lower() in b.lower())


def test_few_runs_leave_a_text(spark):
    """A name of common words is anchored on its rare one: texts without it send nothing on."""
    common = "the bank of the north and the bank of the south " * 20
    bodies = [(k, common) for k in range(50)] + [(50, common + "the bank of zyx"), (51, "zyx")]
    t = spark.createDataFrame(bodies, "k int, body string")
    n = spark.createDataFrame([(0, "the bank of zyx"), (1, "bank of qqq")], "j int, name string")
    lowered = t.select("k", F.lower("body").alias("_low"))
    anchors = E._anchors(n.select(F.col("name").alias("_name")), lowered)
    runs = {r["_name"]: r["_run"] for r in anchors.collect()}
    assert E._few_anchors(list(runs), lowered) == runs
    rare = {"the bank of zyx": b"zyx", "bank of qqq": b"qqq"}
    for name, part in rare.items():
        run = int(runs[name]) & 0xFFFFFFFF
        assert any(b in run.to_bytes(4, "little") for b in part)
    bits, sizes = E._filter_of(anchors), E._sizes(anchors)
    sent = sum(len(r) for b in [pd.array([x for _, x in bodies], dtype="string[pyarrow]")] for _, _, r in E._hits(b._pa_array.combine_chunks(), bits, sizes))
    assert sent <= 3
    assert E.containment_join(t, "k", "body", n, "name").select("k", "j").collect() == [(50, 0)]


# --- pages of lists ----------------------------------------------------------------------


def test_pages_hold_at_most_their_size(spark, monkeypatch):
    monkeypatch.setattr(Q, "ROWS_PER_RANGE", 10)
    rows = [("big", f"t{n:03}") for n in range(47)] * 2 + [("one", "x"), (None, "y"), ("none", None)]
    pages = paged_list(spark.createDataFrame(rows, "k string, i string"), "k", "i", 10)
    got = {(r.k, r.page): (r["items"], r.total) for r in pages.collect()}
    assert got["big", 4] == ([f"t{n:03}" for n in range(40, 47)], 47) and got["one", 0] == (["x"], 1) and len(got) == 6
    assert {r.k: r.text for r in listed(pages, "k", ",").collect()} == {"big": ",".join(f"t{n:03}" for n in range(47)), "one": "x"}


# --- gold refresh ------------------------------------------------------------------------


def gold(spark, sector):
    dim = spark.createDataFrame([("A", "Alpha", sector)], "ticker string, company_name string, sector string")
    bridge = spark.createDataFrame([("f", sector)], "fingerprint string, ticker string")
    return {"company_dim": dim, "event_company_bridge": bridge}


def test_failed_refresh_leaves_all_tables(spark, tmp_path):
    folder = str(tmp_path)
    assert sinks.full_refresh(gold(spark, "old"), folder) == ["company_dim", "event_company_bridge"]
    broken = gold(spark, "new")
    broken["event_company_bridge"] = broken["event_company_bridge"].withColumn("ticker", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        sinks.full_refresh(broken, folder)
    assert sinks.gold_table(spark, folder, "company_dim").first().sector == "old"
    assert sinks.gold_table(spark, folder, "event_company_bridge").first().ticker == "old"
    sinks.full_refresh(gold(spark, "new"), folder)
    assert sinks.gold_table(spark, folder, "company_dim").first().sector == "new"


def test_empty_frame_keeps_its_table_and_old_files_go(spark, tmp_path):
    folder = str(tmp_path)
    for n in range(4):
        frames = gold(spark, f"s{n}")
        if n:
            frames["company_dim"] = frames["company_dim"].where("false")
        sinks.full_refresh(frames, folder)
    assert sinks.gold_table(spark, folder, "company_dim").first().sector == "s0"
    assert sinks.gold_table(spark, folder, "event_company_bridge").first().ticker == "s3"
    kept = sorted(p.name for p in (tmp_path / "data").iterdir())
    assert kept == ["refresh=0", "refresh=2", "refresh=3"] and sinks.gold_table(spark, folder, "company_dim").schema == GOLD["company_dim"]


def test_measured_write_counts_what_it_wrote(spark, tmp_path):
    df = spark.createDataFrame([(n, "x" if n % 3 else None) for n in range(30)], "n int, t string")
    rules = {"small": F.col("n") < 25, "text": F.col("t").isNotNull()}
    for run in ("r1", "r2"):
        events = {r.metric_name: r.metric_value for r in sinks.write_measured(df, rules, str(tmp_path), run).collect()}
        assert events == {"read": 30, "kept": 16, "rejected_small": 5, "rejected_text": 9}
    assert spark.read.parquet(f"{tmp_path}/rows").where("not rejected").count() == 32
    assert spark.read.parquet(f"{tmp_path}/run_events").count() == 8


# --- files -------------------------------------------------------------------------------


def test_archived_pages_round_trip(spark, tmp_path):
    pages = [("raw/2024/01/a.html.gz", "<p>é</p>"), ("raw/2024/01/a.html.gz", "<p>é</p>"), ("raw/2024/02/b.html.gz", None), (None, "x")]
    df = spark.createDataFrame(pages, "raw_html_path string, html string")
    assert files.write_archived_pages(df, str(tmp_path)).count() == 2
    with open(tmp_path / "raw/2024/02/c.html.gz", "wb") as out:
        out.write(gzip.compress(b"cut off")[:-9])
    got = {r.raw_html_path: r.html for r in files.read_archived_pages(spark, str(tmp_path)).collect()}
    assert got == {"raw/2024/01/a.html.gz": "<p>é</p>", "raw/2024/02/b.html.gz": "", "raw/2024/02/c.html.gz": None}


def test_named_csv_files_carry_their_key(spark, tmp_path):
    rows = [("AB - x y.csv", "2024-01-02", "1.5", "2K"), ("AB - x y.csv", "bad", "1", "1"), ("note.csv", "2024-01-02", "9", "9"), ("C1 - z.csv", "03/01/2024", "2", "x")]
    df = spark.createDataFrame(rows, "file string, `Date ` string, Dernier string, `Vol.` string").select(
        "*", *[F.lit("0").alias(c) for c in ("Ouv.", "Plus Haut", "Plus Bas", "Variation %")])
    files.write_named_csv(df, f"{tmp_path}/history", "file")
    assert sorted(p.name for p in (tmp_path / "history").glob("*.csv")) == ["AB - x y.csv", "C1 - z.csv", "note.csv"]
    got = sorted((r.ticker, str(r.date), r.close, r.volume) for r in files.read_price_files(spark, f"{tmp_path}/history/*.csv").collect())
    assert got == [("AB", "2024-01-02", 1.5, 2000.0), ("C1", "2024-01-03", 2.0, None)]


# --- user functions ----------------------------------------------------------------------


def test_per_group_and_its_limit(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2), (None, 7)], "k string, v int")
    top = lambda rows: pd.DataFrame({"top": [int(rows["v"].max())]})
    got = per_group(df, ["k"], top, "top int")
    assert sorted(got.collect(), key=str) == sorted([("a", 5), ("b", 2), (None, 7)], key=str)
    with pytest.raises(ValueError, match="2 rows"):
        per_group(df, ["k"], top, "top int", most_rows=1)


class Letters:
    def eval(self, text):
        for n, c in enumerate(text or ""):
            yield n, c


def test_rows_from(spark):
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None), (1, "c")], "i int, t string")
    assert sorted(rows_from(df, "t", Letters, "n int, c string").select("i", "n", "c").collect()) == [(1, 0, "a"), (1, 0, "c"), (1, 1, "b")]


# --- models ------------------------------------------------------------------------------


def test_predictions_are_versions(spark, tmp_path):
    def rows(p):
        return spark.createDataFrame([("A", datetime.date(2024, 1, d), 1, 0.1, int(p > 0.5), p, 0.2) for d in (1, 2)], L.PREDICTION_SCHEMA)

    assert [L.store_predictions(str(tmp_path), "m", rows(p)) for p in (0.2, 0.9)] == [0, 1]
    assert {r.p_up for r in L.stored_predictions(spark, str(tmp_path), "m").collect()} == {0.9}
    assert {r.p_up for r in L.stored_predictions(spark, str(tmp_path), "m", 0).collect()} == {0.2}


def test_sentiment_model_learns_the_line(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(0, 2, 400)
    df = pd.DataFrame({"ticker": "A", "date": datetime.date(2024, 1, 1), "avg_sentiment": x, "next_day_return": 0.3 - 0.05 * x})
    df["direction"] = (df["next_day_return"] > 0.3).astype("int32")
    train = spark.createDataFrame(df)
    model = L.fit_sentiment(train)
    assert model.first().slope == pytest.approx(-0.05) and model.first().sign == -1
    made = L.predict_by_sentiment(train, model).agg(F.avg((F.col("direction") == F.col("pred_direction")).cast("int")).alias("hit"), F.max(F.abs(F.col("pred_return") - F.col("next_day_return")))).first()
    assert made[0] > 0.95 and made[1] < 1e-5


def test_grid_rows_per_fold(spark):
    rnd = np.random.default_rng(5)
    n = 120
    df = pd.DataFrame({"date": [datetime.date(2024, 1, 1) + datetime.timedelta(days=i // 2) for i in range(n)], "x": rnd.normal(size=n)})
    df["direction"] = (df["x"] + rnd.normal(size=n) > 0).astype("int32")
    grid = L.logistic_grid(L.assemble(spark.createDataFrame(df), ["x"]), strengths=(0.01, 1.0)).collect()
    assert sorted((r.fold, r.reg, r.train_rows, r.valid_rows) for r in grid) == [(f, s, 20 * f, 20) for f in range(1, 6) for s in (0.01, 1.0)]
    assert all(0.5 < r.auc <= 1 for r in grid if r.fold > 1)


# --- a long feed -------------------------------------------------------------------------


def test_counters_of_a_90_day_feed_are_whole_and_state_is_released(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    for part in range(9):                                  # a file for ten days, every tenth row ten days late
        rows = [("a", start + datetime.timedelta(days=d, hours=1)) for day in range(10) for d in [part * 10 + day - (10 if part and day == 4 else 0)]]
        spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    feed = STREAM.read_feed(spark, f"{tmp_path}/feed", spark.createDataFrame([], "k string, ts timestamp").schema, "ts", files_per_batch=1)
    counters = STREAM.running_counts(feed, "k", "ts")
    STREAM.change_log(counters, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    state = STREAM.latest_state(spark.read.parquet(f"{tmp_path}/out"), ["k", "week"])
    assert state.agg(F.sum("n")).first()[0] == 90
    assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() <= 5      # of 13 weeks


def test_stored_tables_come_in_parts_by_rows(spark, monkeypatch):
    """What a session stores is dealt by its rows, whatever few bytes they are; settings go back after it."""
    monkeypatch.setattr(warehouse, "ROWS_PER_PART", 200)
    w = warehouse.Warehouse(spark, SF)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before, seen = spark.conf.get(key, None), []
    w.once_in("parts-by-rows", lambda folder: seen.append((int(spark.conf.get(key)), spark.range(10).groupBy("id").count().count())))
    assert seen == [(-(-w.table("lineitem").count() // 200), 10)]
    assert spark.conf.get(key, None) == before
