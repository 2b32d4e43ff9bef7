"""Registered queries that run a stream or fit a model."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.constants import MODEL_FEATURES
from tickerloom.operators import learn as L
from tickerloom.operators import daily as D
from tickerloom.operators import market as MK
from tickerloom.operators.keyed import unknown_only
from tickerloom.plans.catalog import query
from tickerloom.session import stored, work_folder
from tickerloom.sources.keyed_table import KeyedTable
from tickerloom.sources.upsert import insert_ignore, upsert
from tickerloom.streaming import feed as ST

# --- streaming ---------------------------------------------------------------------------


def _feed(w):
    return ST.read_feed(w.spark, w.folder, w.table("events").schema, "ts", "events.parquet")


FILE_DAYS = 5   # days of events per file of the feed


def _feed_in_batches(w):
    """The feed as it arrives: files of ``FILE_DAYS`` days each, one per micro-batch, and every ninth
    event only with the next file, so late by that many days.  They are written one after the other,
    since a stream takes files in the order of their times."""
    folder = work_folder(w.spark, "feed")
    events = w.table("events")
    span = events.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")).first()
    number = F.floor(F.datediff(F.to_date("ts"), F.lit(span["first"])) / FILE_DAYS) + (F.col("event_id") % 9 == 4).cast("int")
    for n in range((span["last"] - span["first"]).days // FILE_DAYS + 2 if span["first"] else 0):
        events.where(number == n).write.mode("append").parquet(folder)
    return ST.read_feed(w.spark, folder, events.schema, "ts", "*.parquet", files_per_batch=1)


@query("I1_feed_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def i1(w):
    """A poll's repeats go in the stream, repeats of what an earlier poll stored at the table."""
    folder = work_folder(w.spark, "feed-dedup")
    unique = ST.dedup_feed(_feed_in_batches(w).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts")
    table = KeyedTable.create(w.spark.createDataFrame([], "user_id bigint, event_type string"), f"{folder}/table", ["user_id", "event_type"], 16)
    insert = lambda old, batch: insert_ignore(old, batch.select("user_id", "event_type"), ["user_id", "event_type"])
    ST.upsert_stream(unique, table, f"{folder}/checkpoint", insert).awaitTermination()
    return table.read()


@query("I2_late_cut", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY")
def i2(w):
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return ST.drain(ST.recent_only(_feed(w), "ts", 7, as_of).select("event_id"), "late-cut")


@query("I3_stream_upsert", "SELECT user_id, count(*) AS n, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1")
def i3(w):
    folder = work_folder(w.spark, "stream-upsert")
    empty = w.spark.createDataFrame([], "user_id bigint, n bigint, last_day date")
    table = KeyedTable.create(empty, f"{folder}/table", ["user_id"], 16)

    def merge(old, batch):
        part = batch.groupBy("user_id").agg(F.count("*").alias("n"), F.to_date(F.max("ts")).alias("last_day"))
        before = old.select("user_id", F.col("n").alias("_n"), F.col("last_day").alias("_day"))
        total = part.join(before, "user_id", "left").select(
            "user_id", (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"), F.greatest("last_day", "_day").alias("last_day")
        )
        return upsert(old, total, ["user_id"])

    ST.upsert_stream(_feed_in_batches(w), table, f"{folder}/checkpoint", merge).awaitTermination()
    return table.read()


@query("I3_stream_insert_ignore", "SELECT DISTINCT user_id, event_type FROM events")
def i3_bridge(w):
    folder = work_folder(w.spark, "stream-bridge")
    table = KeyedTable.create(w.spark.createDataFrame([], "user_id bigint, event_type string"), f"{folder}/table", ["user_id", "event_type"], 16)
    merge = lambda old, batch: insert_ignore(old, batch.select("user_id", "event_type"), ["user_id", "event_type"])
    ST.upsert_stream(_feed_in_batches(w), table, f"{folder}/checkpoint", merge).awaitTermination()
    return table.read()


@query("I4_running_counts", "SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n, CAST(min(ts) AS DATE) AS first_seen FROM events GROUP BY 1, 2")
def i4(w):
    changes = ST.drain(ST.running_counts(_feed_in_batches(w), "event_type", "ts"), "counters", "update")
    state = ST.latest_state(changes, ["event_type", "week"])
    return state.select("event_type", F.to_date("week").alias("week"), "n", F.to_date("first_seen").alias("first_seen"))


@query("I5_daily_windows", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2", rounded="total")
def i5(w):
    aggs = [F.count("*").alias("n"), F.sum("value").alias("total")]
    windows = ST.windowed(_feed_in_batches(w), "ts", ["event_type"], aggs, "1 day")
    return ST.drain_windows(windows, ["event_type"], "daily").select(F.to_date("start").alias("day"), "event_type", "n", "total")


@query("I5_weekly_windows", "SELECT CAST(ts AS DATE) + CAST((8 - isodow(ts)) % 7 AS INTEGER) AS week_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def i5_weekly(w):
    weekly = ST.windowed(_feed_in_batches(w), "ts", ["event_type"], [F.count("*").alias("n")], "7 days", offset=ST.WEEK_OFFSET)
    return ST.drain_windows(weekly, ["event_type"], "weekly").select(F.date_sub(F.to_date("end"), 1).alias("week_start"), "event_type", "n")


@query("I6_sliding_rate", """SELECT CAST(s AS VARCHAR) AS start, count(*) AS n FROM (SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts), INTERVAL 15 MINUTE)) AS s FROM events) GROUP BY 1""")
def i6(w):
    sliding = ST.windowed(_feed_in_batches(w), "ts", [], [F.count("*").alias("n")], "1 hour", "15 minutes")
    return ST.drain_windows(sliding, [], "rate").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("I7_pending_batch", "SELECT event_id FROM events WHERE event_type = 'view' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)")
def i7(w):
    events = w.table("events")
    done = events.where("event_type = 'error' AND value > 100")
    return unknown_only(events.where("event_type = 'view'"), "user_id", done, "user_id").select("event_id")


@query("I7_pending_stream", """SELECT a.event_id, b.event_id AS result_id FROM events a LEFT JOIN events b ON b.event_type = 'purchase' AND b.user_id = a.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 1 DAY
WHERE a.event_type = 'signup'""")
def i7_stream(w):
    feed = _feed_in_batches(w)
    items = feed.where("event_type = 'signup'").select("user_id", "event_id", F.col("ts").alias("at"))
    results = feed.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("result_id"), F.col("ts").alias("done_at"))
    joined = ST.pending_rows(items, results, "user_id", "at", "done_at", "1 day")
    return ST.drain_pending(joined.select("event_id", "result_id"), "event_id", "pending")


@query("I8_live_monitor", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 50")
def i8(w):
    table = ST.drain(_feed(w).select("event_id", "event_type"), "monitor")
    return table.orderBy(F.desc("event_id")).limit(50)


@query("I9_resumed_stream", "SELECT event_id FROM events")
def i9(w):
    folder = work_folder(w.spark, "resume")
    rows = _feed_in_batches(w).select("event_id")
    for _ in range(2):   # the second start finds nothing new behind its checkpoint
        ST.sink(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return w.spark.read.parquet(f"{folder}/out")


# --- models ------------------------------------------------------------------------------


def _dataset(w):
    """News-day rows with features and targets; the labelled days are stored."""
    return w.news_days.select("ticker", "date", "direction", "next_day_return", *MODEL_FEATURES)


@query("M1_feature_rows", f"SELECT count(*) AS n, {len(MODEL_FEATURES)} AS width FROM v_labelled WHERE news_count > 0")
def m1(w):
    from pyspark.ml.functions import vector_to_array

    ready = L.assemble(D.build_daily_signals(w.features, w.base_prices, drop_unlabelled=True).where("news_count > 0"), targets=["direction", "next_day_return"])
    return ready.select(F.size(vector_to_array("features")).alias("width")).groupBy("width").agg(F.count("*").alias("n"))


@query("M2_time_split", """WITH c AS (SELECT quantile_cont(epoch(CAST(date AS TIMESTAMP)), 0.8) AS cut FROM v_labelled WHERE news_count > 0)
SELECT CASE WHEN epoch(CAST(date AS TIMESTAMP)) < cut THEN 'train' ELSE 'test' END AS part, count(*) AS n, min(date) AS first_day, max(date) AS last_day FROM v_labelled, c WHERE news_count > 0 GROUP BY 1""")
def m2(w):
    rows = D.build_daily_signals(w.features, w.base_prices, drop_unlabelled=True).where("news_count > 0").select("ticker", "date")
    train, test = L.time_split(rows)

    def summary(part, df):
        return df.agg(F.lit(part).alias("part"), F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))

    return summary("train", train).unionByName(summary("test", test))


@query("M3_class_weights", """SELECT direction, count(*) AS n, sum(count(*)) OVER () / (2.0 * count(*)) AS weight FROM v_labelled WHERE news_count > 0 GROUP BY 1""", rounded="weight")
def m3_weights(w):
    rows = D.build_daily_signals(w.features, w.base_prices, drop_unlabelled=True).where("news_count > 0").select("direction")
    return L.balanced_weights(rows, "direction").groupBy("direction").agg(F.count("*").alias("n"), F.first("weight").alias("weight"))


@query("M3_M4_forest_predictions")
def m3(w):
    return w.forest_predictions


_TEST_ROWS = "SELECT ticker, date, direction, next_day_return FROM v_news_days WHERE is_test"


@query("M3_M4_forest_checks", f"""SELECT count(*) AS n, min(date) AS first_day, max(date) AS last_day, CAST(sum(direction) AS BIGINT) AS ups, avg(next_day_return) AS mean_return,
 true AS chances_valid, true AS calls_follow_chances, true AS returns_within_training FROM ({_TEST_ROWS})""", rounded="mean_return")
def m3_checks(w):
    train, _ = L.time_split(w.news_days)
    seen = train.agg(F.struct(F.min("next_day_return").alias("low"), F.max("next_day_return").alias("high"))).scalar()
    return w.forest_predictions.agg(
        F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.sum("direction").alias("ups"),
        F.avg("next_day_return").alias("mean_return"), F.bool_and(F.col("p_up").between(0, 1)).alias("chances_valid"),
        F.bool_and((F.col("p_up") == 0.5) | (F.col("pred_direction") == (F.col("p_up") > 0.5).cast("int"))).alias("calls_follow_chances"),
        F.bool_and(F.col("pred_return").between(seen["low"] - 1e-9, seen["high"] + 1e-9)).alias("returns_within_training"))


@query("P24_forest_backtest", f"""SELECT date, avg(next_day_return) AS bh, count(*) AS n_total, true AS positions_counted, true AS within_the_day FROM ({_TEST_ROWS}) GROUP BY date""", rounded="bh")
def p24_forest(w):
    day = w.forest_predictions.groupBy("date").agg(F.min("next_day_return").alias("low"), F.max("next_day_return").alias("high"))
    ok = F.col("strategy").between(F.least("low", F.lit(0.0)) - 1e-12, F.greatest("high", F.lit(0.0)) + 1e-12)
    return MK.backtest(w.forest_predictions).join(day, "date").select(
        "date", "bh", "n_total", F.col("n_pos").between(0, F.col("n_total")).alias("positions_counted"), ok.alias("within_the_day"))


@query("P26_forest_signal_quality", f"""SELECT ticker, count(*) AS n, avg(direction) AS actual_up_rate, true AS rates_valid FROM ({_TEST_ROWS}) GROUP BY ticker""", rounded="actual_up_rate")
def p26_forest(w):
    valid = F.col("pred_up_rate").between(0, 1) & F.col("accuracy").between(0, 1) & (F.col("total_return") >= -1)
    return MK.signal_quality(w.forest_predictions).select("ticker", "n", "actual_up_rate", valid.alias("rates_valid"))


@query("P27_forest_strategies", f"""SELECT series, date, true AS picks_within_rule FROM (SELECT DISTINCT date FROM ({_TEST_ROWS})), (VALUES ('S1'), ('S2'), ('S3')) s(series)""")
def p27_forest(w):
    most = F.when(F.col("series") == "S3", 3).otherwise(1)
    return MK.three_strategies(w.forest_predictions).select("series", "date", F.col("n_pos").between(0, most).alias("picks_within_rule"))


@query("M5_class_report", " UNION ALL ".join(f"""SELECT {c} AS class, coalesce(tp * 1.0 / nullif(pp, 0), 0) AS precision, coalesce(tp * 1.0 / nullif(ap, 0), 0) AS recall, coalesce(2.0 * tp / nullif(pp + ap, 0), 0) AS f1, ap AS support, acc AS accuracy, base AS baseline FROM (
 SELECT count(*) FILTER (WHERE direction = {c} AND pred_direction = {c}) AS tp, count(*) FILTER (WHERE pred_direction = {c}) AS pp, count(*) FILTER (WHERE direction = {c}) AS ap, avg(CAST(direction = pred_direction AS INTEGER)) AS acc,
  greatest(avg(direction), 1 - avg(direction)) AS base FROM v_predictions)""" for c in (0, 1)), rounded="precision recall f1 accuracy baseline")
def m5(w):
    return L.class_report(w.predictions, "direction", "pred_direction")


@query("M6_regression_report", """SELECT sqrt(avg(pow(next_day_return - pred_return, 2))) AS rmse, sqrt(avg(next_day_return * next_day_return)) AS rmse_zero, avg(abs(next_day_return - pred_return)) AS mae,
 avg(CAST(sign(next_day_return) = sign(pred_return) AS INTEGER)) AS sign_agreement, 1 - avg(pow(next_day_return - pred_return, 2)) / var_pop(next_day_return) AS r2, count(*) AS n FROM v_predictions""", rounded="rmse rmse_zero mae sign_agreement r2")
def m6(w):
    return L.regression_report(w.predictions, "next_day_return", "pred_return")


@query("M7_confusion", "SELECT direction, pred_direction, count(*) AS n, count(*) * 1.0 / sum(count(*)) OVER () AS share FROM v_predictions GROUP BY 1, 2", rounded="share")
def m7(w):
    return L.confusion(w.predictions, "direction", "pred_direction")


_POINTS = """SELECT p_up AS threshold, CAST(sum(sum(direction)) OVER o AS BIGINT) AS tp, CAST(sum(count(*) - sum(direction)) OVER o AS BIGINT) AS fp,
 sum(sum(direction)) OVER o / sum(sum(direction)) OVER () AS tpr, sum(count(*) - sum(direction)) OVER o / sum(count(*) - sum(direction)) OVER () AS fpr,
 sum(sum(direction)) OVER o / sum(count(*)) OVER o AS precision, sum(direction) / sum(sum(direction)) OVER () AS gain FROM v_predictions GROUP BY p_up WINDOW o AS (ORDER BY p_up DESC)"""


@query("M8_curve_points", f"SELECT threshold, tp, fp, tpr, fpr, precision FROM ({_POINTS})", rounded="threshold tpr fpr precision")
def m8(w):
    return L.curve_points(w.predictions, "direction", "p_up")


@query("M8_area_under_roc", """SELECT (sum(CASE WHEN direction = 1 THEN rk END) - p * (p + 1) / 2.0) / (p * n) AS auc, p AS positives, n AS negatives FROM (
 SELECT direction, rank() OVER (ORDER BY p_up) + (count(*) OVER (PARTITION BY p_up) - 1) / 2.0 AS rk, count(*) FILTER (WHERE direction = 1) OVER () AS p, count(*) FILTER (WHERE direction = 0) OVER () AS n FROM v_predictions) GROUP BY p, n""", rounded="auc")
def m8_auc(w):
    return L.area_under_roc(w.predictions, "direction", "p_up")


@query("M8_average_precision", f"SELECT sum(precision * gain) AS average_precision FROM ({_POINTS})", rounded="average_precision")
def m8_ap(w):
    return L.average_precision(L.precision_recall_points(w.predictions, "direction", "p_up"))


@query("M8_youden_threshold", f"SELECT threshold, tpr - fpr AS j FROM ({_POINTS}) ORDER BY round(j, 9) DESC, threshold DESC LIMIT 1", rounded="threshold j")
def m8_youden(w):
    return L.youden_threshold(L.curve_points(w.predictions, "direction", "p_up"))


def _importance(w):
    train, _ = L.time_split(L.assemble(_dataset(w)))
    return L.feature_importance(L.fit_classifier(stored(train, "train")), MODEL_FEATURES, w.spark)


@query("M9_feature_importance")
def m9(w):
    return _importance(w)


@query("M9_importance_checks", f"SELECT {min(20, len(MODEL_FEATURES))} AS n, true AS shares_of_one, true AS known_features")
def m9_checks(w):
    return _importance(w).agg(
        F.count("*").alias("n"), (F.bool_and(F.col("importance").between(0, 1)) & (F.sum("importance") <= 1 + 1e-9)).alias("shares_of_one"),
        F.bool_and(F.col("feature").isin(*MODEL_FEATURES)).alias("known_features"))


@query("M10_embedding_plane")
def m10(w):
    return L.project_2d(w.table("embeddings"), "embedding").drop("embedding")


@query("M10_plane_checks", "SELECT count(*) AS n, true AS centred, true AS uncorrelated, true AS first_is_widest, true AS no_wider_than_the_whole FROM embeddings WHERE embedding IS NOT NULL")
def m10_checks(w):
    plane = L.project_2d(w.table("embeddings"), "embedding").select("pc1", "pc2")
    whole = L.total_inertia(w.table("embeddings"), "embedding").scalar()
    one = plane.agg(
        F.count("*").alias("n"), F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"), F.var_pop("pc1").alias("v1"), F.var_pop("pc2").alias("v2"),
        F.covar_pop("pc1", "pc2").alias("c"))
    small = F.col("v1") * 1e-6
    return one.select(
        "n", ((F.abs("m1") <= F.sqrt(small)) & (F.abs("m2") <= F.sqrt(small))).alias("centred"), (F.abs("c") <= small).alias("uncorrelated"),
        (F.col("v1") >= F.col("v2")).alias("first_is_widest"), ((F.col("v1") + F.col("v2")) * F.col("n") <= whole * (1 + 1e-9)).alias("no_wider_than_the_whole"))


@query("M11_clusters")
def m11(w):
    return L.cluster(w.table("embeddings"), "embedding").groupBy("cluster").agg(F.count("*").alias("n"))


def _inside(groups):
    """Sum of squared distances of all rows to the mean of their group."""
    cells = groups.select("cluster", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v"))
    return cells.groupBy("cluster", "i").agg((F.var_pop("v") * F.count("v")).alias("ss")).agg(F.sum("ss")).scalar()


@query("M11_cluster_checks", "SELECT count(*) AS n, 5 AS clusters, true AS closer_than_one_group FROM embeddings WHERE embedding IS NOT NULL")
def m11_checks(w):
    groups = stored(L.cluster(w.table("embeddings"), "embedding").select("embedding", "cluster"), "clusters")
    whole = L.total_inertia(w.table("embeddings"), "embedding").scalar()
    return groups.agg(F.count("*").alias("n"), F.countDistinct("cluster").cast("int").alias("clusters")).select(
        "n", "clusters", (_inside(groups) < whole).alias("closer_than_one_group"))


@query("M11_elbow")
def m11_elbow(w):
    return L.elbow(w.table("embeddings"), "embedding")


_INERTIA = "SELECT sum(ss) AS inertia FROM (SELECT i, var_pop(v) * count(*) AS ss FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)"


@query("M11_elbow_checks", f"SELECT 10 AS points, inertia AS one_group, true AS more_groups_are_closer FROM ({_INERTIA})", rounded="one_group")
def m11_elbow_checks(w):
    curve = L.elbow(w.table("embeddings"), "embedding")
    return curve.agg(
        F.count("*").cast("int").alias("points"), F.max(F.when(F.col("k") == 1, F.col("inertia"))).alias("one_group"),
        (F.max(F.when(F.col("k") > 1, F.col("inertia"))) < F.max(F.when(F.col("k") == 1, F.col("inertia")))).alias("more_groups_are_closer"))


@query("M11_total_inertia", "SELECT sum(ss) AS inertia FROM (SELECT i, var_pop(v) * count(*) AS ss FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)", rounded="inertia")
def m11_inertia(w):
    return L.total_inertia(w.table("embeddings"), "embedding")


@query("M12_group_checks", "SELECT count(*) AS n, true AS at_most_five, true AS closer_than_one_group FROM embeddings WHERE embedding IS NOT NULL")
def m12_checks(w):
    groups = stored(L.group_by_cosine(w.table("embeddings"), "embedding").select("embedding", "cluster"), "groups")
    whole = L.total_inertia(w.table("embeddings"), "embedding").scalar()
    return groups.agg(F.count("*").alias("n"), F.countDistinct("cluster").alias("c")).select(
        "n", F.col("c").between(1, 5).alias("at_most_five"), (_inside(groups) <= whole).alias("closer_than_one_group"))


@query("M12_cosine_groups")
def m12(w):
    return L.group_by_cosine(w.table("embeddings"), "embedding").groupBy("cluster").agg(F.count("*").alias("n"))


@query("M13_logistic_grid")
def m13(w):
    return L.logistic_grid(L.assemble(_dataset(w))).select("fold", "reg", "auc")


@query("M13_grid_checks", """WITH days AS (SELECT date, ntile(6) OVER (ORDER BY date) AS block FROM (SELECT DISTINCT date FROM v_news_days)),
 sizes AS (SELECT block, count(*) AS n FROM v_news_days JOIN days USING (date) GROUP BY block)
SELECT CAST(fold AS INTEGER) AS fold, reg, CAST(sum(n) FILTER (WHERE block <= fold) AS BIGINT) AS train_rows, CAST(sum(n) FILTER (WHERE block = fold + 1) AS BIGINT) AS valid_rows, true AS auc_valid
FROM sizes, generate_series(1, 5) f(fold), (VALUES (0.01::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE)) r(reg) GROUP BY fold, reg""")
def m13_checks(w):
    grid = L.logistic_grid(L.assemble(_dataset(w)))
    return grid.select("fold", "reg", "train_rows", "valid_rows", F.coalesce(F.col("auc").between(0, 1), F.lit(True)).alias("auc_valid"))


def _reloaded(w):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel

    train, test = L.time_split(L.assemble(_dataset(w)))
    path = work_folder(w.spark, "model")
    model = LogisticRegression(labelCol="direction").fit(stored(train, "train"))
    L.save_model(model, path)
    return model.transform(test), LogisticRegressionModel.load(path).transform(test)


@query("M14_saved_model")
def m14(w):
    _, scored = _reloaded(w)
    return scored.select("ticker", "date", "direction", F.col("prediction").cast("int").alias("pred_direction"))


@query("M14_reload_checks", f"SELECT count(*) AS n, 0 AS changed FROM ({_TEST_ROWS})")
def m14_checks(w):
    before, after = (df.select("ticker", "date", F.col("prediction").alias(name)) for df, name in zip(_reloaded(w), ("a", "b"), strict=True))
    return before.join(after, ["ticker", "date"], "full").agg(
        F.count("*").alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).cast("int").alias("changed"))
