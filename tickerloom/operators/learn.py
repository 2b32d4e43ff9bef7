"""Model training and evaluation on MLlib, with evaluation tables as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.constants import MODEL_FEATURES
from tickerloom.operators.forest import fit_forest
from tickerloom.operators.quantiles import exact_quantiles, ranked_values
from tickerloom.operators.stats import ratio
from tickerloom.session import stored
from tickerloom.sources.keyed_table import KeyedTable

SEED = 42
PREDICTION_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("date", T.DateType()), T.StructField("direction", T.IntegerType()),
    T.StructField("next_day_return", T.DoubleType()), T.StructField("pred_direction", T.IntegerType()),
    T.StructField("p_up", T.DoubleType()), T.StructField("pred_return", T.DoubleType()),
])
PREDICTIONS = PREDICTION_SCHEMA.names


def assemble(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, targets: Sequence[str] = ()) -> DataFrame:
    """Feature vector; rows with a missing feature or target are dropped."""
    present = [c for c in features if c in df.columns]
    usable = df.dropna(subset=[*present, *targets])
    return VectorAssembler(inputCols=present, outputCol="features").transform(usable)


def cutoff(df: DataFrame, date: str = "date", train_share: float = 0.8) -> Column:
    """Interpolated quantile of the date (dates are counted first); fetches that one value."""
    days = df.groupBy(date).agg(F.count("*").alias("_n")).withColumn("_t", F.unix_timestamp(F.col(date).cast("timestamp")))
    at = exact_quantiles(days, "_t", {"t": train_share}, weight="_n").first()["t"]
    return F.timestamp_micros(F.lit(round(at * 1_000_000)))


def time_split(df: DataFrame, date: str = "date", train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train strictly before the cut-off, test from it on; no shuffling of rows."""
    at = cutoff(df, date, train_share)
    ts = F.col(date).cast("timestamp")
    return df.where(ts < at), df.where(ts >= at)


def balanced_weights(train: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (classes * n_class) per row; the class table has one row per class and goes to all tasks."""
    classes = train.groupBy(label).agg(F.count("*").alias("_n"))
    totals = classes.agg(F.sum("_n").alias("s"), F.count("*").alias("k")).select(F.struct("s", "k")).scalar()
    table = classes.withColumn("_t", totals).select(label, (F.col("_t.s") / (F.col("_t.k") * F.col("_n"))).alias(out))
    return train.join(F.broadcast(table), label)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` in as many even parts as there are cores, for fits of many passes: a part for each file,
    as they are read, leaves cores idle in every pass, and each part more sends statistics of all nodes."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def fit_classifier(train: DataFrame, label: str = "direction", trees: int = 300, depth: int = 6, min_leaf: int = 20) -> Model:
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, seed=SEED, cacheNodeIds=True,
    )
    classes = balanced_weights(train.select(label), label).groupBy(label, "weight").agg(F.count("*").alias("n")).collect()   # a row per class
    known = train.where(F.col(label).isNotNull())
    return fit_forest(forest, known, spread(known), {float(c[label]): (c["weight"], c["n"]) for c in classes})


def fit_regressor(train: DataFrame, label: str = "next_day_return", trees: int = 300, depth: int = 6, min_leaf: int = 20) -> Model:
    forest = RandomForestRegressor(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, seed=SEED, predictionCol="pred_return", cacheNodeIds=True,
    )
    return fit_forest(forest, train, spread(train))


def predict(test: DataFrame, classifier: Model, regressor: Model) -> DataFrame:
    """(ticker, date, direction, next_day_return, pred_direction, p_up, pred_return)."""
    both = regressor.transform(classifier.transform(test))
    return both.select(
        "ticker", "date", "direction", "next_day_return",
        F.col("prediction").cast("int").alias("pred_direction"),
        vector_to_array("probability")[1].alias("p_up"), "pred_return",
    )


def forest_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test predictions of the class and return forests fitted on ``train``."""
    train, test = stored(assemble(train), "train"), assemble(test)
    return predict(test, fit_classifier(train), fit_regressor(train))


def fit_sentiment(train: DataFrame, feature: str = "avg_sentiment") -> DataFrame:
    """One-factor baseline, one row: the least-squares line of the next return on ``feature``, and the
    centre, spread and sign by which the feature speaks for a rise."""
    x, up, r = F.col(feature), F.col("direction").cast("double"), F.col("next_day_return")
    slope = F.try_divide(F.covar_pop(r, x), F.var_pop(x))
    return train.dropna(subset=[feature, "direction", "next_day_return"]).agg(
        F.coalesce(slope, F.lit(0.0)).alias("slope"), (F.avg(r) - F.coalesce(slope, F.lit(0.0)) * F.avg(x)).alias("intercept"),
        F.avg(x).alias("centre"), F.stddev_pop(x).alias("spread"), F.signum(F.round(F.covar_pop(up, x), 12)).alias("sign"),
    )


def predict_by_sentiment(test: DataFrame, model: DataFrame, feature: str = "avg_sentiment") -> DataFrame:
    """(ticker, date, direction, next_day_return, pred_direction, p_up, pred_return); the chance of a
    rise moves by 0.15 per spread of the feature, within 0 and 1."""
    m = model.select(F.struct("*")).scalar()
    z = F.coalesce(F.try_divide(F.col(feature) - m["centre"], m["spread"]), F.lit(0.0)) * m["sign"]
    return test.select(
        "ticker", "date", "direction", "next_day_return",
        F.round(F.greatest(F.least(0.5 + 0.15 * z, F.lit(1.0)), F.lit(0.0)), 6).alias("p_up"),
        F.round(m["intercept"] + m["slope"] * F.col(feature), 6).alias("pred_return"),
    ).withColumn("pred_direction", (F.col("p_up") >= 0.5).cast("int"))


def store_predictions(folder: str, model: str, predictions: DataFrame) -> int:
    """Write a model's predictions as the next version of its table; reports read the newest one."""
    spark, rows = predictions.sparkSession, predictions.select(*PREDICTIONS)
    path = f"{folder}/{model}"
    try:
        table = KeyedTable(spark, path, rows.schema, ["ticker", "date"])
        return table.replace(rows, table.version() + 1)
    except AnalysisException:              # the first fit
        KeyedTable.create(rows, path, ["ticker", "date"])
        return 0


def stored_predictions(spark: SparkSession, folder: str, model: str, version: int | None = None) -> DataFrame:
    """A model's stored predictions, by default the newest."""
    return KeyedTable(spark, f"{folder}/{model}", PREDICTION_SCHEMA, ["ticker", "date"]).read(version)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def feature_importance(model: Model, features: Sequence[str], spark: SparkSession, top: int = 20) -> DataFrame:
    """The model's own importance list (one entry per feature) as a table."""
    rows = [(name, float(v)) for name, v in zip(features, model.featureImportances.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


# --- evaluation --------------------------------------------------------------------------

def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    cells = df.groupBy(label, predicted).agg(F.count("*").alias("n"))
    return cells.withColumn("share", F.col("n") / cells.agg(F.sum("n")).scalar())


def class_report(df: DataFrame, label: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Per class: precision, recall, F1, support, with overall accuracy and majority baseline."""
    y, p = F.col(label), F.col(predicted)
    aggs = [F.count("*").alias("_n"), F.count_if(y == p).alias("_hit")]
    for c in classes:
        aggs += [
            F.count_if((y == c) & (p == c)).alias(f"_tp{c}"), F.count_if(p == c).alias(f"_pp{c}"),
            F.count_if(y == c).alias(f"_ap{c}"),
        ]
    one = df.agg(*aggs)
    support = [F.col(f"_ap{c}") for c in classes]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("class"),
            ratio(F.col(f"_tp{c}"), F.col(f"_pp{c}")).alias("precision"),
            ratio(F.col(f"_tp{c}"), F.col(f"_ap{c}")).alias("recall"),
            ratio(2.0 * F.col(f"_tp{c}"), F.col(f"_pp{c}") + F.col(f"_ap{c}")).alias("f1"),
            F.col(f"_ap{c}").alias("support"),
            F.try_divide(F.col("_hit"), F.col("_n")).alias("accuracy"),
            F.try_divide(F.greatest(*support), F.col("_n")).alias("baseline"),
        )
        for c in classes
    ])
    return one.select(F.inline(rows))


def regression_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, p = F.col(label), F.col(predicted)
    return df.dropna(subset=[label, predicted]).agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.sqrt(F.avg(y * y)).alias("rmse_zero"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg((F.signum(y) == F.signum(p)).cast("int")).alias("sign_agreement"),
        (1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("r2"),
        F.count("*").alias("n"),
    )


def curve_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """True and false positives at every distinct threshold, best score first.

    Thresholds are counted per distinct score and accumulated in balanced buckets, so neither
    a common score nor a long list of scores meets in one task.
    """
    by_score = df.dropna(subset=[label, score]).groupBy(score).agg(
        F.count("*").alias("_all"), F.sum(F.col(label).cast("long")).alias("_pos")
    )
    keyed = by_score.withColumn("_key", -F.col(score))
    everyone = ranked_values(keyed, "_key", weight="_all").select("_key", (F.col("before") + F.col("n")).alias("seen"), "total")
    positive = ranked_values(keyed, "_key", weight="_pos").select(
        "_key", (F.col("before") + F.col("n")).alias("tp"), F.col("total").alias("positives")
    )
    joined = everyone.join(positive, "_key")
    negatives = F.col("total") - F.col("positives")
    fp = F.col("seen") - F.col("tp")
    return joined.select(
        (-F.col("_key")).alias("threshold"), "tp", fp.alias("fp"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("tpr"),
        F.try_divide(fp, negatives).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("seen")).alias("precision"),
    )


def youden_threshold(points: DataFrame) -> DataFrame:
    gain = F.col("tpr") - F.col("fpr")
    return points.orderBy(gain.desc_nulls_last(), F.desc("threshold")).limit(1).select("threshold", gain.alias("j"))


def area_under_roc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank-sum form of the area: (sum of positive ranks - P(P+1)/2) / (P*N), ties averaged; one row
    per group of ``by``."""
    by = list(by)
    counted = df.dropna(subset=[label, score]).groupBy(*by, score).agg(
        F.count("*").alias("_all"), F.sum(F.col(label).cast("long")).alias("_pos")
    )
    ranks = ranked_values(counted, score, by, weight="_all").select(
        *by, score, (F.col("before") + (F.col("n") + 1) / 2).alias("_rank")
    )
    sums = counted.join(ranks, [*by, score]).groupBy(*by).agg(
        F.sum(F.col("_rank") * F.col("_pos")).alias("r"), F.sum("_pos").alias("p"), F.sum("_all").alias("n")
    )
    p, n = F.col("p"), F.col("n") - F.col("p")
    return sums.select(*by, F.try_divide(F.col("r") - p * (p + 1) / 2, p * n).alias("auc"), p.alias("positives"), n.alias("negatives"))


def average_precision(points: DataFrame) -> DataFrame:
    """Sum of precision times the recall gained at each threshold.

    The gain is read from the counts of the threshold itself, so no ordering is needed.
    """
    return points.agg(F.sum(F.col("precision") * F.col("gain")).alias("average_precision"))


def precision_recall_points(df: DataFrame, label: str, score: str) -> DataFrame:
    points = curve_points(df, label, score)
    own = df.dropna(subset=[label, score]).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("_own")
    )
    total = df.dropna(subset=[label, score]).agg(F.sum(F.col(label).cast("long"))).scalar()
    return points.join(own, "threshold").select(
        "threshold", "precision", F.col("tpr").alias("recall"), F.try_divide(F.col("_own"), total).alias("gain")
    )


def with_blocks(df: DataFrame, date: str = "date", folds: int = 5) -> DataFrame:
    """``df`` with ``block`` 1 to ``folds + 1``: consecutive spans of as many dates each.  Fold ``i``
    trains on the blocks up to ``i`` and validates on the next one."""
    day = F.to_date(date)
    days = df.select(day.alias("_day")).distinct()   # one row per calendar day, whatever the rows
    block = F.ntile(folds + 1).over(W.orderBy("_day"))
    return df.withColumn("_day", day).join(days.select("_day", block.alias("block")), "_day").drop("_day")


def logistic_grid(
    df: DataFrame, label: str = "direction", strengths: Sequence[float] = (0.01, 0.1, 1.0), folds: int = 5, at_once: int = 4
) -> DataFrame:
    """Validation AUC of L2 logistic regression per strength and fold, with the rows of both sides.

    The rows are stored once with their block; a fold is a weight column that leaves later blocks out,
    so all fits read one cached table, ``at_once`` of them side by side.  The fitted models are rows of
    a small table, and one pass scores every validation row with the models of its fold.
    """
    spark = df.sparkSession
    names = [label, "features", "block"]
    rows = stored(with_blocks(df, folds=folds).select(*names), "folds").select(
        *names, *[(F.col("block") <= i).cast("double").alias(f"in{i}") for i in range(1, folds + 1)]).persist()

    def fit(task: tuple[int, float]) -> tuple[int, float, float, list[float]]:
        fold, strength = task
        model = LogisticRegression(labelCol=label, weightCol=f"in{fold}", regParam=strength, elasticNetParam=0.0).fit(rows)
        return fold, strength, float(model.intercept), [float(c) for c in model.coefficients]

    tasks = [(i, s) for i in range(1, folds + 1) for s in strengths]
    with ThreadPoolExecutor(at_once) as pool:
        fitted = list(pool.map(inheritable_thread_target(spark)(fit), tasks))
    sizes = rows.groupBy("block").agg(F.count("*").alias("n"))
    rows.unpersist()
    models = spark.createDataFrame(fitted, "fold int, reg double, intercept double, weights array<double>")
    valid = rows.drop(*[f"in{i}" for i in range(1, folds + 1)]).withColumn("fold", F.col("block") - 1).join(F.broadcast(models), "fold")
    product = F.zip_with(vector_to_array("features"), "weights", lambda x, c: x * c)
    scored = valid.select("fold", "reg", label, (F.col("intercept") + F.aggregate(product, F.lit(0.0), lambda t, x: t + x)).alias("score"))
    every = F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("fold")
    by_fold = sizes.select("block", "n", every).groupBy("fold").agg(
        F.sum(F.when(F.col("block") <= F.col("fold"), F.col("n"))).alias("train_rows"),
        F.sum(F.when(F.col("block") == F.col("fold") + 1, F.col("n"))).alias("valid_rows"))
    counted = models.select("fold", "reg").join(by_fold, "fold")
    return counted.join(area_under_roc(scored, label, "score", ["fold", "reg"]).select("fold", "reg", "auc"), ["fold", "reg"], "left")


# --- embeddings --------------------------------------------------------------------------

def as_vectors(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def project_2d(df: DataFrame, column: str) -> DataFrame:
    """First two principal components of the centred vectors (signs are arbitrary)."""
    vectors = as_vectors(df, column)
    centred = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="centred").fit(vectors).transform(vectors)
    reduced = PCA(k=2, inputCol="centred", outputCol="pcs").fit(centred).transform(centred)
    xy = vector_to_array("pcs")
    return reduced.withColumn("pc1", xy[0]).withColumn("pc2", xy[1]).drop("features", "centred", "pcs")


def total_inertia(vectors: DataFrame, column: str) -> DataFrame:
    """Sum of squared distances to the mean: the k = 1 point of the elbow curve."""
    cells = vectors.select(F.posexplode(F.col(column).cast("array<double>")).alias("i", "v"))
    per_axis = cells.groupBy("i").agg((F.var_pop("v") * F.count("v")).alias("ss"))
    return per_axis.agg(F.sum("ss").alias("inertia"))


def cluster(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    vectors = as_vectors(df, column)
    return KMeans(k=k, seed=SEED).fit(vectors).transform(vectors).drop("features").withColumnRenamed("prediction", "cluster")


def elbow(df: DataFrame, column: str, ks: Sequence[int] = tuple(range(1, 11))) -> DataFrame:
    """(k, inertia) for each k; the vectors are cached across the fits and released after them."""
    vectors = as_vectors(df, column).select(column, "features").persist()
    out = None
    for k in ks:
        if k == 1:
            row = total_inertia(vectors, column).select(F.lit(1).alias("k"), "inertia")
        else:
            cost = KMeans(k=k, seed=SEED).fit(vectors).summary.trainingCost
            row = df.sparkSession.range(1).select(F.lit(k).alias("k"), F.lit(float(cost)).alias("inertia"))
        out = row if out is None else out.unionByName(row)
    vectors.unpersist()
    return out


def group_by_cosine(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """Top-down hierarchical grouping under cosine distance."""
    unit = Normalizer(inputCol="features", outputCol="unit").transform(as_vectors(df, column))
    model = BisectingKMeans(k=k, seed=SEED, distanceMeasure="cosine", featuresCol="unit").fit(unit)
    return model.transform(unit).drop("features", "unit").withColumnRenamed("prediction", "cluster")
