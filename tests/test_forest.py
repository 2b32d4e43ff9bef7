"""Forests grown over stored bins: counts, splits and leaves against brute force, and MLlib's model around them."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tickerloom.operators import forest as FO
from tickerloom.operators import learn as L


def _rows(spark, n=600):
    return L.assemble(spark.range(n).selectExpr(
        "CAST((id * 7) % 50 AS DOUBLE) a", "CAST((id * 13) % 5 AS DOUBLE) b", "CAST(1 AS DOUBLE) c",
        "CAST((id * 7) % 50 > 20 AND id % 9 > 0 AS INT) direction", "((id * 7) % 50) / 10 + (id % 3) next_day_return"), ["a", "b", "c"])


def test_fits_keep_nothing_per_row_and_tree(spark, monkeypatch):
    def stop(*_):
        raise AssertionError("MLlib's own fit keeps over 2 KB a row")

    monkeypatch.setattr(RandomForestClassifier, "_fit", stop)
    monkeypatch.setattr(RandomForestRegressor, "_fit", stop)
    stored, seen = FO.stored, []
    monkeypatch.setattr(FO, "stored", lambda df, label: seen.append(stored(df, label)) or seen[-1])
    rows = _rows(spark)
    models = L.fit_classifier(rows, trees=20, depth=3), L.fit_regressor(rows, trees=20, depth=3)
    assert [m.getNumTrees for m in models] == [20, 20]
    assert [(s.count(), s.agg(F.max(F.length("bins"))).first()[0]) for s in seen] == [(600, 3), (600, 3)]   # a byte per feature
    scored = L.predict(rows.withColumns({"ticker": F.lit("T"), "date": F.lit("2024-01-01")}), *models)
    one = scored.agg(F.avg((F.col("direction") == F.col("pred_direction")).cast("int")), F.corr("pred_return", "next_day_return")).first()
    assert one[0] > 0.9 and one[1] > 0.7
    importance = {r.feature: r.importance for r in L.feature_importance(models[0], ["a", "b", "c"], spark).collect()}
    assert sum(importance.values()) == pytest.approx(1) and importance["a"] > 0.8 and importance["c"] == 0


def test_leaves_are_means_of_drawn_rows(spark):
    rows = _rows(spark).coalesce(1)
    estimator = RandomForestRegressor(labelCol="next_day_return", numTrees=1, maxDepth=2, minInstancesPerNode=20, seed=5, leafCol="leaf")
    model = FO.fit_forest(estimator, rows, rows)
    got = model.transform(rows).select("a", "next_day_return", vector_to_array("leaf")[0].alias("leaf"), "prediction").toPandas()
    drawn = FO._drawn(5, 0, 0, 600)
    means = got.iloc[drawn].groupby("leaf")["next_day_return"].agg(["mean", "size"])
    assert got["leaf"].nunique() == len(means) == 4 and means["size"].min() >= 20
    assert got["prediction"].to_numpy() == pytest.approx(means["mean"].loc[got["leaf"]].to_numpy())
    # the first cut is the best of those there are
    y, a = got["next_day_return"].to_numpy()[drawn], got["a"].to_numpy()[drawn]
    loss = {c: sum(((y[s] - y[s].mean()) ** 2).sum() for s in (a <= c, a > c)) for c in FO.thresholds(got["a"].to_numpy(), np.ones(600), 31)}
    assert float(model.toDebugString.split("feature 0 <= ")[1].split(")")[0]) == min(loss, key=loss.get)
    assert model.featureImportances.toArray()[2] == 0


def test_trees_draw_rows_as_poisson_numbers():
    counts = np.bincount(np.concatenate([FO._drawn(1, 0, t, 1000) + 1000 * t for t in range(20)]), minlength=20_000)
    assert counts.mean() == pytest.approx(1, abs=0.03) and counts.var() == pytest.approx(1, abs=0.06)
    assert (FO._drawn(1, 0, 3, 1000) == FO._drawn(1, 0, 3, 1000)).all()


def test_blocks_end_where_numbers_do(monkeypatch):
    monkeypatch.setattr(FO, "BLOCK_BITS", 2)
    ids = [*range(7), *range(100, 103)]
    table = pa.table({"id": ids, "bins": pa.array([bytes([i % 256, 1]) for i in ids]), "y": [float(i) for i in ids]})
    found = list(FO._blocks(iter(table.to_batches(max_chunksize=3)), 2))
    assert [(first, bins[0].tolist(), y.tolist()) for first, bins, y in found] == [
        (0, [0, 1, 2, 3], [0, 1, 2, 3]), (4, [4, 5, 6], [4, 5, 6]), (100, [100, 101, 102], [100, 101, 102])]


def test_missing_labels_are_refused(spark):
    rows = L.assemble(spark.sql("SELECT 1D x, CAST(NULL AS DOUBLE) next_day_return"), ["x"])
    with pytest.raises(ValueError):
        L.fit_regressor(rows, trees=2)
