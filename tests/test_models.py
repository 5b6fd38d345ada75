"""Classifiers and the linear detector."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from alertloom.operators import models, prepare, triage
from alertloom.params import LABEL_COL, LABELS


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda s: (F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000.0)
    return (
        spark.range(800)
        .withColumn("label", (F.col("id") % 5).cast("double"))
        .withColumn("a", u(1) + F.col("label"))
        .withColumn("b", u(2))
        .withColumn("kind", F.when(u(3) < 0.5, "x").otherwise("y"))
        .withColumn(LABEL_COL, F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("label") + 1).cast("int")))
        .drop("label")
        .repartition(4)
        .cache()
    )


@pytest.fixture(scope="module")
def prepared(rows):
    pipeline = prepare.fit_features(rows, categorical=["kind"], exclude=["id"])
    return pipeline, prepare.transform_features(pipeline, rows, keep=["id"]).cache()


def test_forest_predicts_and_repeats(prepared):
    _, data = prepared
    train = prepare.attach_class_weight(data, prepare.class_weight_map(prepare.class_weights(data)))
    fit = lambda: models.fit_random_forest(train, trees=[5], depths=[4, 5], folds=2)
    best = fit()
    out = triage.extract_predictions(best.transform(data), keep=["id"])
    assert out.count() == data.count()
    assert out.filter("true_label = predicted_label").count() > 0.95 * data.count()
    assert out.filter("predicted_proba > 1 OR predicted_proba < 0.2 OR predicted_class NOT BETWEEN 0 AND 4").count() == 0
    again = triage.extract_predictions(fit().transform(data), keep=["id"])
    assert out.exceptAll(again).count() == 0


def _counts(scored):
    rows = scored.groupBy("label", "prediction").count().collect()
    return {(int(r[0]), int(r[1]), r[2]) for r in rows}


@pytest.mark.parametrize("features", ["features", "features_raw"])  # the raw ones have splits on categories
def test_forest_cut_at_a_depth_scores_like_one_grown_to_it(rows, prepared, features):
    pipeline, _ = prepared
    # few classes per leaf, so that leaves merge
    data = pipeline.transform(rows).select("id", F.col(features).alias("features"), F.least("label", F.lit(2.0)).alias("label")).coalesce(1).cache()
    deep, low = (models._forest(6, depth, 7, None).fit(data) for depth in (6, 3))
    found = models.smaller_forest_counts(deep, data, [2, 6], [3, 6]).collect()
    got = {key: {(r.label, r.prediction, r.n) for r in found if (r.trees, r.depth) == key} for key in [(2, 3), (2, 6), (6, 3), (6, 6)]}
    assert got[6, 6] == _counts(deep.transform(data)) and got[6, 3] == _counts(low.transform(data))
    assert got[2, 6] == got_by_two(deep, data) and got[2, 3] == got_by_two(low, data)


def got_by_two(model, data):
    """Confusion counts of the model's first two trees alone, by their own probabilities."""
    for t in range(2):
        data = model.trees[t].setProbabilityCol(f"p{t}").setPredictionCol(f"c{t}").setRawPredictionCol(f"r{t}").transform(data)
    votes = F.zip_with(vector_to_array("p0"), vector_to_array("p1"), lambda a, b: a + b)
    return _counts(data.withColumn("prediction", F.array_position(votes, F.array_max(votes)) - 1))


def test_forest_search_grows_one_forest_a_fold_and_scores_the_grid_like_separate_fits(prepared, monkeypatch):
    _, data = prepared
    train = prepare.kfold_assignment(data, "id", 2)
    fits = []
    made = models._forest
    monkeypatch.setattr(models, "_forest", lambda *a: fits.append(a) or made(*a))
    grid = models.search_random_forest(train, trees=[4], depths=[2, 5], folds=2, weight=None, fold_col="fold")
    assert len(fits) == 2
    evaluator = models.MulticlassClassificationEvaluator(metricName="f1")
    part = models._few_tasks(train, 2).cache()
    for (n, depth), score in grid.items():
        single = [evaluator.evaluate(made(n, depth, 42, None).fit(part.filter(f"fold <> {k}")).transform(part.filter(f"fold = {k}"))) for k in range(2)]
        assert score == pytest.approx(sum(single) / 2)
    assert list(grid) == [(4, 2), (4, 5)]


def test_importance_is_summed_by_source_column(rows, prepared):
    pipeline, data = prepared
    best = models.fit_random_forest(data, trees=[5], depths=[4], folds=2, weight=None)
    table = models.feature_importance(best, pipeline.transform(rows)).collect()
    assert {r.feature for r in table} == {"a", "b", "kind"} and table[0].feature == "a"
    assert sum(r.importance for r in table) == pytest.approx(1.0)


def test_one_vs_rest_boosting_has_classes_but_no_probability(prepared):
    _, data = prepared
    best = models.fit_gbt_one_vs_rest(data, iterations=[2], depths=[3], folds=2, parallelism=4)
    out = best.transform(data)
    assert "probability" not in out.columns and out.count() == data.count()
    assert out.filter("prediction = label").count() > 0.9 * data.count()


def test_prefix_of_an_ensemble_equals_a_shorter_fit(prepared):
    _, data = prepared
    rows = data.select("id", "label", "features").coalesce(1).cache()
    long, short = (models._boosted(n, 3, 0.1, 7).fit(rows) for n in (6, 2))
    raw = lambda m: m.transform(rows).select("id", "prediction", vector_to_array("rawPrediction").alias("raw"))
    assert [len(m.trees) for m in models.one_vs_rest_prefix(long, 2).models] == [2] * 5
    assert raw(models.one_vs_rest_prefix(long, 2)).exceptAll(raw(short)).count() == 0
    assert raw(long).exceptAll(raw(short)).count() > 0


def test_boosted_search_scores_every_grid_point_like_separate_fits(prepared):
    _, data = prepared
    train = prepare.kfold_assignment(data, "id", 2)
    grid = models.search_gbt_one_vs_rest(train, iterations=[1, 3], depths=[1, 2], folds=2, fold_col="fold")
    evaluator = models.MulticlassClassificationEvaluator(metricName="f1")
    for (n, depth), score in grid.items():
        single = [
            evaluator.evaluate(models._boosted(n, depth, 0.1, 42).fit(train.filter(f"fold <> {k}").coalesce(1)).transform(train.filter(f"fold = {k}")))
            for k in range(2)
        ]
        assert score == pytest.approx(sum(single) / 2)
    assert set(grid) == {(1, 1), (3, 1), (1, 2), (3, 2)}


def test_confidence_of_forest_and_boosted_models(prepared):
    _, data = prepared
    boosted = models._boosted(2, 2, 0.1, 7).fit(data.select("id", "label", "features"))
    for model in (boosted, models.fit_random_forest(data, trees=[3], depths=[3], folds=2, weight=None)):
        rows = models.with_confidence(model.transform(data)).select("prediction", "confidence").collect()
        assert all(len(r.confidence) == 5 and 0 <= min(r.confidence) and max(r.confidence) <= 1 for r in rows)
        assert all(r.confidence[int(r.prediction)] == max(r.confidence) for r in rows)


def test_cross_validation_by_fold_column(prepared):
    _, data = prepared
    train = prepare.kfold_assignment(data, "id", 2)
    best = models.fit_random_forest(train, trees=[3], depths=[3], folds=2, weight=None, fold_col="fold")
    assert best.getNumTrees == 3


def test_reconstruction_error_matches_svd(spark):
    rng = np.random.default_rng(3)
    basis = rng.normal(size=(3, 10))
    normal = rng.normal(size=(300, 3)) @ basis + 0.05 * rng.normal(size=(300, 10)) + 4.0
    odd = rng.normal(size=(40, 10)) * 3 + 4.0
    data = [("Normal", r.tolist()) for r in normal] + [("DoS", r.tolist()) for r in odd]
    df = spark.createDataFrame([(i, c, v) for i, (c, v) in enumerate(data)], f"id int, {LABEL_COL} string, v array<double>")
    df = df.withColumn("features", array_to_vector("v"))
    model = models.fit_pca_detector(df)
    assert models.components_for(10) == 4 and models.components_for(122) == 15
    got = {r.id: r.mse for r in models.reconstruction_error(model, df.repartition(7)).select("id", "mse").collect()}
    mean = normal.mean(axis=0)
    _, _, vt = np.linalg.svd(normal - mean, full_matrices=False)
    p = vt[:4].T
    x = np.vstack([normal, odd]) - mean
    expected = ((x - x @ p @ p.T) ** 2).mean(axis=1)
    assert [got[i] for i in range(340)] == pytest.approx(list(expected), rel=1e-6, abs=1e-9)

    model, calibration = models.fit_anomaly_detector(df, df)
    threshold, top = calibration.first()
    assert threshold == pytest.approx(np.percentile(expected[:300], 95)) and top == pytest.approx(expected.max())
    scored = models.anomaly_scores(model, df, calibration)
    assert scored.filter(f"predicted_anomaly AND {LABEL_COL} = 'Normal'").count() == 15
    assert scored.filter(f"NOT predicted_anomaly AND {LABEL_COL} = 'DoS'").count() <= 2


def test_predictions_from_vectors_and_arrays(spark):
    df = spark.createDataFrame(
        [("DoS", 0.0, [0.6, 0.1, 0.1, 0.1, 0.1]), ("Normal", 4.0, [0.2, 0.2, 0.2, 0.1, 0.3])],
        f"{LABEL_COL} string, prediction double, probability array<double>",
    )
    expected = [("DoS", 0, 0.6, "DoS"), ("Normal", 4, 0.3, "U2R")]
    assert [tuple(r) for r in triage.extract_predictions(df).collect()] == expected
    vectors = df.withColumn("probability", array_to_vector("probability"))
    assert [tuple(r) for r in triage.extract_predictions(vectors).collect()] == expected
    assert vectors.select(vector_to_array("probability")).count() == 2


@pytest.mark.parametrize(
    "rows, fits, cores, parts",
    [(0, 30, 12, 1), (65_712, 30, 12, 1), (65_712, 5, 12, 3), (30_000, 5, 64, 2), (394_280, 30, 12, 2), (394_280, 5, 12, 3), (4_000_000, 30, 12, 20)],
)
def test_boosted_fits_share_the_cores_instead_of_dealing_out_small_tasks(rows, fits, cores, parts):
    assert models.task_count(rows, fits, cores) == parts


@pytest.mark.parametrize("rows, fits, cores, parts", [(394_797, 2, 12, 6), (394_797, 1, 12, 12), (3_950_000, 2, 12, 10), (24_000_000, 2, 12, 60)])
def test_forest_fits_have_larger_tasks_as_each_sends_counts_for_every_node(rows, fits, cores, parts):
    assert models.task_count(rows, fits, cores, models.FOREST_TASK_ROWS) == parts
