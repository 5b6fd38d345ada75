"""Boosted ensembles grown by a task each, against the engine's fits and brute force."""

import numpy as np
import pytest
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from alertloom.operators import boosting, models
from alertloom.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(100_000)) / 100_000.0
    columns = {"a": u(1) + F.col("label"), "b": u(2), "c": F.floor(u(3) * 6) + F.col("label"), "d": F.floor(u(4) * 2), "e": F.lit(7.0)}
    table = spark.range(900).withColumn("label", (F.col("id") % 3).cast("double")).withColumns(columns)
    table = VectorAssembler(inputCols=list(columns), outputCol="features").transform(table)
    # without the attributes that assembling leaves, as after scaling
    return table.select("id", "label", F.col("features").alias("features", metadata={})).withColumn("fold", F.col("id") % 2).coalesce(1).cache()


def _raw(model, df):
    return {r.id: (r.prediction, list(r.raw)) for r in model.transform(df).select("id", "prediction", vector_to_array("rawPrediction").alias("raw")).collect()}


def test_ensembles_are_the_engines(spark, rows):
    own, engine = models.fit_boosted(rows, 4, 3, 0.1, 42), models._boosted(4, 3, 0.1, 42).fit(rows)
    got, want = _raw(own, rows), _raw(engine, rows)
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)
    assert [m.treeWeights for m in own.models] == [m.treeWeights for m in engine.models]
    for a, b in zip(own.models, engine.models, strict=True):
        assert a.featureImportances.toArray() == pytest.approx(b.featureImportances.toArray())
        assert (a.numFeatures, a.getMaxIter(), a.getMaxDepth()) == (b.numFeatures, 4, 3)
    path = scratch_path(spark, "saved")
    own.write().save(path)
    assert _raw(OneVsRestModel.load(path), rows) == got


def test_search_is_a_few_jobs_and_scores_as_the_engine_does(spark, rows, monkeypatch):
    grid = {"iterations": [2, 4], "depths": [2, 3], "folds": 2, "fold_col": "fold"}
    sc = spark.sparkContext
    sc.setJobGroup("boosted search", "")
    try:
        found = models.search_gbt_one_vs_rest(rows, **grid)
        # before, a job for every level of every tree
        assert 0 < len(sc.statusTracker().getJobIdsForGroup("boosted search")) < 40
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.setattr(boosting, "MOST_BYTES", 0)
    assert models.search_gbt_one_vs_rest(rows, **grid) == pytest.approx(found)


def test_trees_do_not_depend_on_the_blocks_of_rows(rows):
    parts = {-1: 900}
    fits = [boosting.Fit(-1, c, 3, 4) for c in range(3)]
    made = []
    for n in (1, 5):
        table = rows.select("label", "features", F.lit(0).alias("_fold")).repartition(n)
        made.append(boosting.grow(table, boosting.part_bins(table, parts, 1), fits, 0.1))
    one, five = made
    assert one.num_rows == 9 and one.select(["fit", "tree", "feature", "threshold", "left"]).equals(five.select(["fit", "tree", "feature", "threshold", "left"]))


def test_best_split_is_that_of_all_thresholds_and_the_first_on_ties():
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 9, 300), rng.integers(0, 2, 300), rng.integers(0, 5, 300)], axis=1).astype(float)
    x = np.c_[x, x[:, 0]]  # the same column again
    target = x[:, 0] * x[:, 2] + rng.normal(size=300)
    limits = [boosting.thresholds(c, 32) for c in x.T]
    made = boosting.Bins(limits, boosting.shared_codes([len(v) + 1 for v in limits]))
    tree, said = boosting.Grower(boosting.codes_of(x, made), made, 4).tree(target)

    def check(k, used):
        y = target[used]
        assert tree["prediction"][k] == pytest.approx(y.mean()) and tree["n"][k] == used.sum()
        if tree["left"][k] < 0:
            assert said[used] == pytest.approx(y.mean())
            return
        worth = {}
        for f in range(4):
            for t in limits[f]:
                low = y[x[used, f] <= t]
                if 0 < len(low) < len(y):
                    worth[f, t] = y.var() - (len(low) * low.var() + (len(y) - len(low)) * y[x[used, f] > t].var()) / len(y)
        best = max(worth.values())
        assert tree["gain"][k] == pytest.approx(best)
        assert (tree["feature"][k], tree["threshold"][k]) == next(key for key, v in worth.items() if v > best - 1e-9) and tree["feature"][k] != 3
        down = x[:, tree["feature"][k]] <= tree["threshold"][k]
        check(tree["left"][k], used & down)
        check(tree["right"][k], used & ~down)

    check(0, np.ones(300, bool))
    assert tree["n"].max() == 300 and len(tree["n"]) > 15


def test_rows_of_one_value_and_one_class_make_a_leaf():
    made = boosting.Bins([boosting.thresholds(np.full(6, 2.0), 32)], boosting.shared_codes([1]))
    grower = boosting.Grower(boosting.codes_of(np.full((6, 1), 2.0), made), made, 3)
    trees = list(grower.ensemble(np.zeros(6, bool), 2, 0.1))
    assert [t["prediction"].tolist() for t in trees] == [[-1.0], [pytest.approx(-4 / (1 + np.exp(2)))]]


def test_thresholds_halve_gaps_and_even_out_the_bins():
    assert boosting.thresholds(np.array([3.0, 1.0, 1.0, 5.0]), 32).tolist() == [2.0, 4.0]
    assert boosting.thresholds(np.array([4.0, 4.0]), 32).tolist() == []
    found = boosting.thresholds(np.arange(1000.0), 4)
    assert found.tolist() == [249.5, 499.5, 749.5]


def test_shared_codes_hold_every_feature_once():
    groups = boosting.shared_codes([32, 2, 1, 8, 32, 8, 2], 256)
    assert sorted(f for g in groups for f in g) == [0, 1, 3, 4, 5, 6]
    sizes = np.array([32, 2, 1, 8, 32, 8, 2])
    assert max(np.prod(sizes[g]) for g in groups) <= 256


def test_all_rows_in_one_fold_cannot_be_searched(rows):
    with pytest.raises(ValueError, match="one fold"):
        models.search_gbt_one_vs_rest(rows.withColumn("fold", F.lit(0)), iterations=[1], depths=[1], folds=2, fold_col="fold")
