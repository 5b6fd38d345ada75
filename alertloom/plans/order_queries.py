"""Queries that profile, split and prepare the records of the order tables (``tables.order_records``)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.operators import prepare, profile
from alertloom.plans.catalog import query, rounded, slots
from alertloom.session import scratch_path
from alertloom.sources import sinks, tables
from alertloom.sources.tables import ORDER_CATEGORIES, ORDER_CLASS, ORDER_CLASSES, ORDER_NUMBERS

KEY = "o_orderkey"
#: Orders from this day on are the external set.
EXTERNAL_FROM = "2000-01-01"
#: Shares vary little from order to order.
CONSTANT_LIMIT = 0.05
FOLDS = 5


def _known(spark, sf) -> DataFrame:
    """Orders of known classes with their split."""
    known = prepare.filter_known_classes(tables.order_records(spark, sf).drop("o_orderdate"), ORDER_CLASS, ORDER_CLASSES)
    return prepare.stratified_split(known, KEY)


def _stored(spark, sf) -> DataFrame:
    """The same, written first: fitting reads it several times and the joins should run once."""
    return spark.read.parquet(sinks.write_parquet(_known(spark, sf), scratch_path(spark, "orders"), ["split"]))


def _train(data: DataFrame) -> DataFrame:
    return data.filter("split = 'train'")


@query
def order_records(spark, sf):
    return rounded(tables.order_records(spark, sf), ["revenue", "discount", "tax", "part_size", "retail"])


# --- profile ---------------------------------------------------------------------


@query
def order_null_profile(spark, sf):
    return profile.null_profile(tables.order_records(spark, sf))


@query
def order_class_distribution(spark, sf):
    return profile.class_distribution(tables.order_records(spark, sf), ORDER_CLASS)


@query
def order_categorical_profile(spark, sf):
    return profile.categorical_profile(tables.order_records(spark, sf), [ORDER_CLASS, *ORDER_CATEGORIES], top=3)


@query
def part_categorical_profile(spark, sf):
    return profile.categorical_profile(tables.read_table(spark, sf, "part"), ["p_brand", "p_type", "p_size", "p_name"])


@query
def order_describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(tables.order_records(spark, sf), ORDER_NUMBERS), ["mean", "stddev"])


@query
def order_quasi_constant(spark, sf):
    return rounded(profile.quasi_constant(tables.order_records(spark, sf), ORDER_NUMBERS, CONSTANT_LIMIT), ["std_dev"])


@query
def order_label_correlation(spark, sf):
    found = profile.label_correlation(tables.order_records(spark, sf), ORDER_NUMBERS, ORDER_CLASS)
    return rounded(found, ["corr", "corr_abs"])


@query
def order_class_shift(spark, sf):
    """Earlier orders of known classes against all later ones."""
    later = F.col("o_orderdate") >= F.lit(EXTERNAL_FROM).cast("timestamp_ntz")
    orders = tables.read_table(spark, sf, "orders").select("o_orderdate", ORDER_CLASS)
    train = prepare.filter_known_classes(orders.filter(~later), ORDER_CLASS, ORDER_CLASSES)
    return profile.class_shift(train, orders.filter(later), ORDER_CLASS)


# --- splits and weights -----------------------------------------------------------


@query
def order_split_sizes(spark, sf):
    return prepare.split_sizes(_known(spark, sf))


@query
def order_split_class_pivot(spark, sf):
    return prepare.split_class_pivot(_known(spark, sf), ORDER_CLASS)


@query
def order_stratified_split(spark, sf):
    return _known(spark, sf).select(KEY, ORDER_CLASS, "split")


@query
def order_split_overlaps(spark, sf):
    return prepare.split_overlaps(_known(spark, sf).select(KEY, "split"), KEY)


@query
def order_kfold_assignment(spark, sf):
    return prepare.kfold_assignment(_train(_known(spark, sf)), KEY, FOLDS).select(KEY, "fold")


@query
def order_union_class_parts(spark, sf):
    orders = tables.read_table(spark, sf, "orders").select(KEY, ORDER_CLASS)
    return prepare.union_parts([prepare.filter_class(orders, c, ORDER_CLASS) for c in ORDER_CLASSES])


@query
def order_class_weights(spark, sf):
    return prepare.class_weights(_train(_known(spark, sf)), ORDER_CLASS, len(ORDER_CLASSES))


@query
def order_attach_class_weight(spark, sf):
    """Every order with the weight of its class; one of no known class has 1.0."""
    weights = prepare.class_weight_map(order_class_weights(spark, sf), ORDER_CLASS, ORDER_CLASSES)
    orders = tables.read_table(spark, sf, "orders")
    position = F.array_position(F.array(*map(F.lit, ORDER_CLASSES)), F.col(ORDER_CLASS)) - 1
    return prepare.attach_class_weight(orders.withColumn("label", position), weights).select(KEY, ORDER_CLASS, "class_weight")


# --- features ----------------------------------------------------------------------


@query
def order_label_index(spark, sf):
    """All orders; the class that training did not have gets the index after the last."""
    model = prepare.label_indexer(ORDER_CLASS, unseen="keep").fit(_train(_known(spark, sf)))
    orders = tables.read_table(spark, sf, "orders").select(KEY, ORDER_CLASS)
    return model.transform(orders).select(KEY, ORDER_CLASS, "label")


def _encoded(spark, sf):
    """(data with indexes and one-hot vectors, slots per category as fitted)."""
    data = _stored(spark, sf)
    stages = [prepare.category_indexer(ORDER_CATEGORIES), prepare.one_hot_encoder(ORDER_CATEGORIES)]
    model = Pipeline(stages=stages).fit(_train(data))
    sizes = {c: len(labels) for c, labels in zip(ORDER_CATEGORIES, model.stages[0].labelsArray, strict=True)}
    return model.transform(data), sizes


@query
def order_category_index(spark, sf):
    return _encoded(spark, sf)[0].select(KEY, *[f"{c}_idx" for c in ORDER_CATEGORIES])


@query
def order_one_hot(spark, sf):
    encoded, sizes = _encoded(spark, sf)
    return slots(
        prepare.assembler([f"{c}_ohe" for c in ORDER_CATEGORIES], "hot").transform(encoded), "hot", sum(sizes.values()), [KEY]
    )


@query
def order_assemble_features(spark, sf):
    encoded, sizes = _encoded(spark, sf)
    raw = prepare.assembler([*ORDER_NUMBERS, *[f"{c}_ohe" for c in ORDER_CATEGORIES]]).transform(encoded)
    return slots(raw, "features_raw", len(ORDER_NUMBERS) + sum(sizes.values()), [KEY, "split"])


def _fitted(spark, sf):
    """(stages fitted on the training orders, orders with split)."""
    data = _stored(spark, sf)
    return prepare.fit_features(_train(data).drop("split"), ORDER_CATEGORIES, ORDER_CLASS, exclude=[KEY]), data


def _features(model, data) -> DataFrame:
    out = prepare.transform_features(model, data, ORDER_CLASS, keep=[KEY, "split"])
    n = len(ORDER_NUMBERS) + sum(len(labels) for labels in model.stages[1].labelsArray)
    return slots(out, "features", n, [KEY, "split", "label", ORDER_CLASS])


@query
def order_feature_pipeline(spark, sf):
    return _features(*_fitted(spark, sf))


@query
def order_pipeline_roundtrip(spark, sf):
    """Rows that the fitted stages and the same stages, saved and read back, give only one of; 0 for both."""
    model, data = _fitted(spark, sf)
    again = sinks.load_model(sinks.save_model(model, scratch_path(spark, "order-stages")))
    before, after = _features(model, data), _features(again, data)
    sides = before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(-1)))
    # rows of both sides meet by their content; the difference counts repeated rows as well
    met = sides.groupBy(*before.columns).agg(F.sum("_side").alias("more"), F.count_if(F.col("_side") == 1).alias("n"))
    return met.groupBy("split").agg(
        F.sum("n").alias("n"),
        F.sum(F.greatest("more", F.lit(0))).alias("only_before"),
        F.sum(F.greatest(-F.col("more"), F.lit(0))).alias("only_after"),
    )
