"""Cleaning, splitting, class weights and the feature pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.functions.expressions import fold_index, label_position, split_name
from alertloom.params import CATEGORICAL, CLASSES, DEFAULTS, LABEL_COL, LABELS, LEAK_COLUMNS

SPLITS = ("train", "val", "test")


# --- rows and columns ---------------------------------------------------------


def drop_leak_columns(df: DataFrame, leak: Sequence[str] = LEAK_COLUMNS) -> DataFrame:
    return df.select([c for c in df.columns if c not in leak])


def filter_known_classes(df: DataFrame, column: str = LABEL_COL, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Rows of a known class. For training data only; an external test set keeps all rows."""
    return df.filter(F.col(column).isin(*classes))


def filter_class(df: DataFrame, value: str, column: str = LABEL_COL) -> DataFrame:
    return df.filter(F.col(column) == value)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts put together by column name."""
    return reduce(DataFrame.unionByName, parts)


# --- splits -------------------------------------------------------------------


def stratified_split(
    df: DataFrame, key: str | Column, train: float = DEFAULTS.train_share, val: float = DEFAULTS.val_share
) -> DataFrame:
    """Adds ``split``. Every class is divided in the same proportions because the
    draw does not depend on the class; no shuffle, no count, the same on every run."""
    return df.withColumn("split", split_name(key, train=train, val=val))


def split_parts(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(df.filter(F.col("split") == s).drop("split") for s in SPLITS)


def split_overlaps(df: DataFrame, key: str, parts: Sequence[str] = SPLITS) -> DataFrame:
    """Keys that two splits share, and keys of all rows that no split or a second row has: all 0 for a proper split.

    ``check`` names the pair, or ``missing`` (keys in no split) and ``repeated`` (rows beyond their distinct keys).
    """
    held = {p: F.count_if(F.col("split") == p).alias(p) for p in parts}
    # one row per key, so one shuffle serves all checks
    keys = df.groupBy(key).agg(F.count("*").alias("_rows"), *held.values())
    placed = sum((F.col(p) for p in parts), F.lit(0))
    checks = {f"{a} & {b}": ((F.col(a) > 0) & (F.col(b) > 0)).cast("bigint") for a, b in combinations(parts, 2)}
    checks |= {"missing": F.col("_rows") - placed, "repeated": F.greatest(placed - 1, F.lit(0))}
    sums = keys.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in checks.items()])
    rows = [F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("n")) for name in checks]
    return sums.select(F.inline(F.array(*rows)))


def mark_seen(df: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """``df`` with ``seen``: whether its value of ``column`` occurs in ``train``; a null is unseen."""
    known = train.select(F.col(column).alias("_known")).filter("_known IS NOT NULL").distinct()
    unseen = df.join(known, F.col(column) == F.col("_known"), "left_anti").withColumn("seen", F.lit(False))
    return df.join(known, F.col(column) == F.col("_known"), "left_semi").withColumn("seen", F.lit(True)).unionByName(unseen)


def kfold_assignment(df: DataFrame, key: str | Column, k: int) -> DataFrame:
    return df.withColumn("fold", fold_index(key, k))


def seeded_shuffle(df: DataFrame, key: str, seed: int = DEFAULTS.seed, epoch: int = 0) -> DataFrame:
    """Rows in an order drawn from key, seed and epoch; the key breaks ties."""
    drawn = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(epoch))))
    return df.withColumn("shuffle_key", drawn).orderBy("shuffle_key", key)


def split_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.select(column, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def split_class_pivot(df: DataFrame, column: str = LABEL_COL, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Percentage of each class within each split, one row per class."""
    counts = df.groupBy(column).agg(*[F.count_if(F.col("split") == s).alias(s) for s in splits])
    total = Window.partitionBy()
    return counts.select(
        column, *[F.round(F.try_divide(F.col(s) * 100.0, F.sum(s).over(total)), 2).alias(s) for s in splits]
    )


# --- weights --------------------------------------------------------------------


def class_weights(df: DataFrame, column: str = LABEL_COL, k: int = len(CLASSES)) -> DataFrame:
    """n / (k * n_class) per class, k being the number of known classes."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(column, "n", F.round(total / (F.lit(k) * F.col("n")), 4).alias("weight"))


def class_weight_map(weights: DataFrame, column: str = LABEL_COL, labels: Sequence[str] = LABELS) -> DataFrame:
    """Weights keyed by class index; classes without an index are left out."""
    return weights.select(label_position(column, labels).alias("label"), "weight").filter("label is not null")


def attach_class_weight(df: DataFrame, weight_map: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``class_weight``, 1.0 where the class has none. The lookup is by integer index.

    The map has a row per known class, so it may be broadcast.
    """
    lookup = F.broadcast(weight_map.select(F.col("label").alias("_label"), F.col("weight").alias("_weight")))
    return (
        df.join(lookup, F.col(label).cast("int") == F.col("_label"), "left")
        .withColumn("class_weight", F.coalesce("_weight", F.lit(1.0)))
        .drop("_label", "_weight")
    )


def label_table(spark, labels: Sequence[str] = LABELS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(labels)), "label int, name string")


def label_lookup(df: DataFrame, index: str, labels: Sequence[str] = LABELS) -> DataFrame:
    """Class name for a class index through the label table (as long as the label list)."""
    names = F.broadcast(label_table(df.sparkSession, labels))
    return df.join(names, F.col(index) == F.col("label"), "left").drop("label")


# --- feature pipeline -------------------------------------------------------------


def label_indexer(column: str = LABEL_COL, unseen: str = "error") -> StringIndexer:
    """Alphabetical class index; ``unseen="keep"`` gives classes that training did not have the index after the last."""
    return StringIndexer(inputCol=column, outputCol="label", stringOrderType="alphabetAsc", handleInvalid=unseen)


def category_indexer(columns: Sequence[str] = CATEGORICAL) -> StringIndexer:
    """Most frequent value first; unseen values and nulls get the last index.

    One stage for all columns counts them in a single pass.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot_encoder(columns: Sequence[str] = CATEGORICAL) -> OneHotEncoder:
    """One slot per value seen in training; anything else is all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns], dropLast=True
    )


def feature_columns(df: DataFrame, categorical: Sequence[str] = CATEGORICAL, label: str = LABEL_COL, exclude=()):
    """Numeric columns by exclusion, then the one-hot blocks."""
    skip = {*categorical, label, *exclude}
    return [c for c in df.columns if c not in skip] + [f"{c}_ohe" for c in categorical]


def assembler(columns: Sequence[str], output: str = "features_raw") -> VectorAssembler:
    """Rows with a null feature are dropped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")


def scaler(source: str = "features_raw", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def fit_features(
    train: DataFrame, categorical: Sequence[str] = CATEGORICAL, label: str = LABEL_COL, exclude: Sequence[str] = ()
) -> PipelineModel:
    """Label index, category index, one-hot, assembly and scaling, all fitted on ``train``."""
    columns = feature_columns(train, categorical, label, exclude)
    stages = [
        label_indexer(label),
        category_indexer(categorical),
        one_hot_encoder(categorical),
        assembler(columns),
        scaler(),
    ]
    return Pipeline(stages=stages).fit(train)


def transform_features(
    model: PipelineModel, df: DataFrame, label: str = LABEL_COL, keep: Sequence[str] = ()
) -> DataFrame:
    """``features``, ``label`` and the class name; ``keep`` adds row keys."""
    return model.transform(df).select(*keep, "features", "label", label)


def fitted_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)
