"""Forests grown by tasks, against brute force and the engine's predictions."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from alertloom.operators import boosting, forests, models
from alertloom.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(100_000)) / 100_000.0
    columns = {"a": 2 * u(1) + F.col("label"), "b": u(2), "c": F.floor(u(3) * 6) + F.col("label"), "d": F.floor(u(4) * 2), "e": F.lit(7.0)}
    table = spark.range(900).withColumn("label", (F.col("id") % 3).cast("double")).withColumns(columns)
    table = VectorAssembler(inputCols=list(columns), outputCol="features").transform(table)
    weight = F.when(F.col("label") == 2, 3.0).otherwise(0.5)
    table = table.select("id", "label", F.col("features").alias("features", metadata={}), weight.alias("w"))
    return table.withColumn("fold", F.col("id") % 2).coalesce(2).cache()


@pytest.fixture
def by_tasks(monkeypatch):
    monkeypatch.setattr(models, "ENGINE_FOREST_ROWS", 0)


def _counts(scored):
    return {(int(r[0]), int(r[1]), r[2]) for r in scored.groupBy("label", "prediction").count().collect()}


def test_model_of_grown_trees_votes_as_its_nodes_do_and_can_be_saved(spark, rows, by_tasks):
    model = models._fit_forest_by_tasks(rows, 7, 5, 42, "w")
    assert (model.getNumTrees, model.numClasses, model.numFeatures, model.getMaxDepth()) == (7, 3, 5, 5)
    out = model.transform(rows)
    hits = lambda m: m.transform(rows).filter("prediction = label").count()
    assert hits(model) > 500 and hits(model) == pytest.approx(hits(models._forest(7, 5, 42, "w").fit(rows)), abs=90)
    found = models.smaller_forest_counts(model, rows, [7], [5]).collect()
    assert {(r.label, r.prediction, r.n) for r in found} == _counts(out)
    assert model.featureImportances.toArray()[4] == 0.0 and sum(model.featureImportances.toArray()) == pytest.approx(1.0)
    path = scratch_path(spark, "saved")
    model.write().save(path)
    assert _counts(RandomForestClassificationModel.load(path).transform(rows)) == _counts(out)


def test_search_and_fit_of_many_rows_grow_by_tasks(rows, monkeypatch, by_tasks):
    grown = []
    made = forests.grow
    monkeypatch.setattr(forests, "grow", lambda *a: grown.append(a[2]) or made(*a))
    model = models.fit_random_forest(rows, trees=[3, 6], depths=[1, 4], folds=2, weight="w", fold_col="fold")
    search, fit = grown
    assert {part: sum(j.last - j.first for j in search if j.part == part) for part in (0, 1)} == {0: 6, 1: 6}
    assert sum(j.last - j.first for j in fit) == model.getNumTrees and model.getMaxDepth() == 4
    scores = models.search_random_forest(rows, [3, 6], [1, 4], 2, weight="w", fold_col="fold")
    assert list(scores) == [(3, 1), (3, 4), (6, 1), (6, 4)] and scores[6, 4] > scores[6, 1]
    engine = models._forest(6, 4, 42, "w")
    assert engine.fit(rows).totalNumNodes / engine.getNumTrees() == pytest.approx(model.totalNumNodes / model.getNumTrees, rel=0.5)


def test_few_rows_and_features_by_category_stay_with_the_engine(rows, monkeypatch):
    assert models._fit_forest_by_tasks(rows, 3, 3, 42, "w") is None
    monkeypatch.setattr(models, "ENGINE_FOREST_ROWS", 0)
    kinds = {"ml_attr": {"attrs": {"binary": [{"idx": 3, "name": "d"}]}, "num_attrs": 5}}
    assert models._fit_forest_by_tasks(rows.withColumn("features", F.col("features").alias("features", metadata=kinds)), 3, 3, 42, "w") is None
    monkeypatch.setattr(forests, "MOST_BYTES", 10)
    assert models._fit_forest_by_tasks(rows, 3, 3, 42, "w") is None


def test_fold_without_rows_is_refused(rows, by_tasks):
    with pytest.raises(ValueError, match="fold 1 has no rows"):
        models.search_random_forest(rows.withColumn("fold", F.lit(0)), [2], [2], 2, weight=None, fold_col="fold")


def test_tree_of_one_feature_has_the_best_splits_of_its_draw():
    x = np.random.default_rng(2).integers(0, 12, 400).astype(float)
    label = (x > 5).astype(np.int32) + (np.random.default_rng(3).random(400) < 0.3)
    weight = np.where(label == 2, 4.0, 1.0)
    limits = boosting.thresholds(x, 32)
    codes = forests.bins_of(x[:, None], boosting.Bins([limits], []))
    tree = forests.grow_tree(codes, label, weight, 3, 3, np.random.default_rng(9))
    times = np.random.default_rng(9).poisson(1.0, 400)

    def stats(used):
        return np.bincount(label[used], (times * weight)[used], 3)

    def check(k, used):
        own = stats(used)
        assert tree["stats"][k] == pytest.approx(own) and tree["n"][k] == times[used].sum()
        if tree["left"][k] < 0:
            return 1
        gini = lambda s: s.sum() - (s**2).sum() / s.sum() if s.sum() else 0.0
        gains = [(gini(own) - gini(stats(used & (x <= t))) - gini(stats(used & (x > t)))) / own.sum() for t in limits]
        assert tree["gain"][k] == pytest.approx(max(gains)) and gains[tree["last"][k]] == pytest.approx(max(gains))
        down = x <= limits[tree["last"][k]]
        return check(tree["left"][k], used & down) + check(tree["right"][k], used & ~down)

    assert check(0, np.ones(400, bool)) == (tree["left"] < 0).sum() > 2


def test_leaves_of_one_class_merge_from_below():
    tree = {
        "stats": np.array([[5.0, 4], [1, 3], [4, 1], [3, 1], [1, 0]]), "n": np.arange(5), "gain": np.array([0.1, -1, 0.1, -1, -1]),
        "feature": np.array([0, -1, 1, -1, -1]), "last": np.zeros(5, int), "left": np.array([1, -1, 3, -1, -1]), "right": np.array([2, -1, 4, -1, -1]),
    }
    got = forests.pruned(tree, [1, 2, 2])
    assert got["left"].tolist() == [1, -1, -1] and got["right"].tolist() == [2, -1, -1] and got["n"].tolist() == [0, 1, 2]


def test_thresholds_follow_the_weights():
    values = np.arange(100.0)
    even = boosting.thresholds(values, 2)
    heavy = boosting.thresholds(values, 2, np.where(values < 10, 9.0, 1.0))
    assert even.tolist() == [49.5] and heavy.tolist() == [9.5]
