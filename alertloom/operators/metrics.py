"""Classification metrics over the confusion counts.

One pass over the rows gives (label, prediction, n), at most k*k rows; every
metric is arithmetic on those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.functions.expressions import label_name
from alertloom.params import LABEL_COL, LABELS, NORMAL


def confusion_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def _class_counts(counts: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """Per class: rows of the class, rows predicted as it, hits and the total."""
    n = F.col("n")
    entries = [
        F.struct(
            F.lit(i).alias("class"),
            F.coalesce(F.sum(F.when(F.col("label") == i, n)), F.lit(0)).alias("actual"),
            F.coalesce(F.sum(F.when(F.col("prediction") == i, n)), F.lit(0)).alias("predicted"),
            F.coalesce(F.sum(F.when((F.col("label") == i) & (F.col("prediction") == i), n)), F.lit(0)).alias("hits"),
            F.sum(n).alias("total"),
        )
        for i in range(k)
    ]
    return counts.groupBy(*by).agg(F.array(*entries).alias("c")).select(*by, F.inline("c"))


def _per_class(counts: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    p, r = F.col("p"), F.col("r")
    return (
        _class_counts(counts, k, by)
        .withColumn("p", ratio("hits", "predicted"))
        .withColumn("r", ratio("hits", "actual"))
        .withColumn("f", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
        .withColumn("share", F.col("actual") / F.col("total"))
    )


def multiclass_metrics(counts: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, weighted precision / recall / F1 and macro F1.

    ``f1_weighted`` weighs classes by their rows; ``f1_macro`` is the plain mean
    over the classes that occur in the labels or the predictions.
    """
    weighted = lambda c: F.round(F.sum(F.col("share") * F.col(c)), 4)
    return (
        _per_class(counts, len(labels), by)
        .groupBy(*by)
        .agg(
            F.round(F.sum("hits") / F.max("total"), 4).alias("accuracy"),
            weighted("p").alias("weighted_precision"),
            weighted("r").alias("weighted_recall"),
            weighted("f").alias("f1_weighted"),
            F.round(F.avg(F.when((F.col("actual") > 0) | (F.col("predicted") > 0), F.col("f"))), 4).alias("f1_macro"),
        )
    )


def weighted_f1(counts: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """F1 weighed by the rows of each of the ``k`` classes, unrounded, as ``f1``."""
    return _per_class(counts, k, by).groupBy(*by).agg(F.sum(F.col("share") * F.col("f")).alias("f1"))


def recall_per_class(counts: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Recall of every listed class, 0.0 for a class without rows."""
    return _per_class(counts, len(labels), by).select(
        *by, label_name("class", labels).alias("class"), F.col("actual").alias("n"), F.round("r", 4).alias("recall")
    )


def model_report(counts: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ("model",)) -> DataFrame:
    """One row per model: overall metrics and a recall column per class."""
    recalls = recall_per_class(counts, labels, by).groupBy(*by).agg(
        *[F.max(F.when(F.col("class") == name, F.col("recall"))).alias(f"recall_{name}") for name in labels]
    )
    return multiclass_metrics(counts, labels, by).join(recalls, list(by))


def confusion_matrix(counts: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """k x k matrix, true class on the rows, zero for empty cells."""
    cells = [
        F.coalesce(F.sum(F.when((F.col("label") == i) & (F.col("prediction") == j), F.col("n"))), F.lit(0)).alias(name)
        for i in range(len(labels))
        for j, name in enumerate(labels)
    ]
    k = len(labels)
    rows = [
        F.struct(F.lit(name).alias("true_label"), *cells[i * k : (i + 1) * k]) for i, name in enumerate(labels)
    ]
    return counts.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def best_model(report: DataFrame, metric: str = "f1_macro", tie_break: str = "model") -> DataFrame:
    return report.orderBy(F.desc(metric), tie_break).limit(1)


def overfit_check(val: DataFrame, test: DataFrame, metric: str = "f1_macro", limit: float = 0.05) -> DataFrame:
    """Drop of the metric from validation to test per model, flagged above the limit."""
    pairs = val.select("model", F.col(metric).alias("val")).join(test.select("model", F.col(metric).alias("test")), "model")
    return pairs.withColumn("drop", F.round(F.col("val") - F.col("test"), 4)).withColumn(
        "overfit", F.col("val") - F.col("test") > limit
    )


# --- detection --------------------------------------------------------------------


def binary_detection_metrics(
    df: DataFrame,
    flag: str = "predicted_anomaly",
    label: str = LABEL_COL,
    normal: str = NORMAL,
    by: Sequence[str] = (),
) -> DataFrame:
    """tp / tn / fp / fn of a detector with recall, precision and F1. A null flag or label is no hit and no attack."""
    hit, attack = F.coalesce(F.col(flag), F.lit(False)), F.coalesce(F.col(label) != normal, F.lit(False))
    counts = df.groupBy(*by).agg(
        F.count_if(hit & attack).alias("tp"),
        F.count_if(~hit & ~attack).alias("tn"),
        F.count_if(hit & ~attack).alias("fp"),
        F.count_if(~hit & attack).alias("fn"),
    )
    tiny = 1e-9
    rates = counts.withColumn("recall", F.col("tp") / (F.col("tp") + F.col("fn") + tiny)).withColumn(
        "precision", F.col("tp") / (F.col("tp") + F.col("fp") + tiny)
    )
    return rates.withColumn(
        "f1", 2 * F.col("recall") * F.col("precision") / (F.col("recall") + F.col("precision") + tiny)
    )


def accuracy_by_class(df: DataFrame, label: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    return df.groupBy(label).agg(
        F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"), F.count("*").alias("n")
    )
