"""Metrics against Spark's evaluator and small hand counts."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from alertloom.operators import metrics
from alertloom.params import LABELS


@pytest.fixture(scope="module")
def predicted(spark):
    h = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(100))
    label = F.when(h(1) < 60, 1).when(h(1) < 85, 0).when(h(1) < 95, 2).otherwise(3)
    return (
        spark.range(3000)
        .withColumn("label", label.cast("double"))
        .withColumn("prediction", F.when(h(2) < 80, F.col("label")).otherwise(F.pmod(h(3), F.lit(4))).cast("double"))
        .cache()
    )


def test_weighted_metrics_match_the_evaluator(predicted):
    row = metrics.multiclass_metrics(metrics.confusion_counts(predicted)).first()
    evaluator = MulticlassClassificationEvaluator()
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1_weighted": "f1"}
    for ours, theirs in names.items():
        assert row[ours] == pytest.approx(evaluator.evaluate(predicted, {evaluator.metricName: theirs}), abs=5e-5)
    assert row.f1_macro != pytest.approx(row.f1_weighted, abs=1e-3)


def test_macro_f1_is_the_mean_over_occurring_classes(predicted):
    evaluator = MulticlassClassificationEvaluator(metricName="fMeasureByLabel")
    each = [evaluator.evaluate(predicted, {evaluator.metricLabel: float(i)}) for i in range(4)]
    assert metrics.multiclass_metrics(metrics.confusion_counts(predicted)).first().f1_macro == pytest.approx(sum(each) / 4, abs=5e-5)


def test_recall_of_an_absent_class_is_zero(predicted):
    got = {r["class"]: (r.n, r.recall) for r in metrics.recall_per_class(metrics.confusion_counts(predicted)).collect()}
    assert got["U2R"] == (0, 0.0) and set(got) == set(LABELS)


def test_confusion_matrix_is_complete(predicted):
    rows = metrics.confusion_matrix(metrics.confusion_counts(predicted)).collect()
    assert [r.true_label for r in rows] == list(LABELS)
    assert sum(r[c] for r in rows for c in LABELS) == 3000 and all(r["U2R"] == 0 for r in rows)


def test_best_model_and_overfit_flag(spark):
    schema = "model string, f1_macro double"
    val = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.5)], schema)
    test = spark.createDataFrame([("a", 0.8), ("b", 0.88), ("c", 0.6)], schema)
    assert metrics.best_model(val).first().model == "a"
    got = {r.model: (r["drop"], r.overfit) for r in metrics.overfit_check(val, test).collect()}
    assert got == {"a": (0.1, True), "b": (0.02, False), "c": (-0.1, False)}


def test_detection_metrics_without_any_hit(spark):
    df = spark.createDataFrame([("Normal", False), ("DoS", False)], "attack_category string, predicted_anomaly boolean")
    row = metrics.binary_detection_metrics(df).first()
    assert (row.tp, row.tn, row.fp, row.fn) == (0, 1, 0, 1) and row.recall == row.precision == row.f1 == 0.0
