"""Registered queries: operator calls wired to the test tables.

Each takes (spark, sf_dir) and reads whole tables. Results that are sums or
ratios are rounded here so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import OneVsRestModel, RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertloom.functions import expressions as fx
from alertloom.operators import distribution, learning, metrics, models, ordered, prepare, profile, triage
from alertloom.params import (
    CATEGORICAL,
    CLASSES,
    DEFAULTS,
    FEATURE_COLUMNS,
    LABEL_COL,
    LABELS,
    NORMAL_INDEX,
    NUMERIC_FEATURES,
    PROFILED,
    RAW_COLUMNS,
)
from alertloom.session import scratch_path, spread
from alertloom.sources import sinks, tables
from alertloom.streaming import triage as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINEITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    # adding 0.0 turns a negative zero into a plain one
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def slots(df: DataFrame, vector: str, n: int, keep: Sequence[str]) -> DataFrame:
    """Vector slots as columns f00, f01, ..."""
    arrays = df.select(*keep, vector_to_array(vector).alias("_a"))
    return arrays.select(*keep, *[(F.round(F.col("_a")[i], 6) + F.lit(0.0)).alias(f"f{i:02d}") for i in range(n)])


# --- shared inputs ----------------------------------------------------------------


def argmax_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return triage.with_action(tables.alerts(spark, sf), fx.policy_argmax("predicted_class"))


def argmax_log(spark: SparkSession, sf: str) -> DataFrame:
    """Only what the decision window needs, since these columns are shuffled."""
    return argmax_decisions(spark, sf).select("alert_id", "stream_id", "ts", "true_label", "action")


def known_split(spark: SparkSession, sf: str) -> DataFrame:
    """Clean records of known classes with their split."""
    clean = prepare.drop_leak_columns(prepare.filter_known_classes(tables.labelled_records(spark, sf)))
    return prepare.stratified_split(clean, "record_id")


def stored_split(spark: SparkSession, sf: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The same, written first, as fitting reads it several times; only ``columns`` are made and written."""
    data = known_split(spark, sf).select(*columns)
    return spark.read.parquet(sinks.write_parquet(data, scratch_path(spark, "clean"), ["split"]))


def alert_split(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.stratified_split(tables.alerts(spark, sf), "alert_id")


def fitted(spark: SparkSession, sf: str):
    """(pipeline fitted on train, records with split)."""
    data = stored_split(spark, sf)
    train = data.filter("split = 'train'").drop("split")
    return prepare.fit_features(train, exclude=["record_id"]), data


def learned_q(spark: SparkSession, sf: str) -> DataFrame:
    """Action values learned from the training alerts: a fitted table of 180 rows."""
    return learning.learn_policy(alert_split(spark, sf).filter("split = 'train'"))


def class_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return metrics.confusion_counts(df, "true_class", "predicted_class", by)


def two_models(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion counts per split of the given classes and of a variant that calls unsure alerts normal."""
    a = alert_split(spark, sf)
    cautious = F.when(F.col("predicted_proba") < 0.5, NORMAL_INDEX).otherwise(F.col("predicted_class"))
    counts = a.groupBy("split", "true_class", "predicted_class", cautious.alias("cautious_class")).agg(
        F.count("*").alias("n")
    )
    spread = F.array(
        F.struct(F.lit("cautious").alias("model"), F.col("cautious_class").alias("prediction")),
        F.struct(F.lit("plain").alias("model"), F.col("predicted_class").alias("prediction")),
    )
    return (
        counts.select("split", F.col("true_class").alias("label"), "n", F.inline(spread))
        .groupBy("model", "split", "label", "prediction")
        .agg(F.sum("n").alias("n"))
    )


# --- sources and sinks --------------------------------------------------------------


@query
def scan_csv_positional(spark, sf):
    path = scratch_path(spark, "records-csv")
    sinks.write_csv(tables.records(spark, sf).drop("record_id"), path, header=False)
    return tables.read_labelled_records(spark, path)


@query
def scan_parquet(spark, sf):
    return tables.read_table(spark, sf, "lineitem")


@query
def sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "clean")
    sinks.write_parquet(prepare.drop_leak_columns(tables.labelled_records(spark, sf)), path)
    return spark.read.parquet(path)


@query
def pipeline_roundtrip(spark, sf):
    model, data = fitted(spark, sf)
    path = sinks.save_model(model, scratch_path(spark, "pipeline"))
    again = sinks.load_model(path)
    out = prepare.transform_features(again, data, keep=["record_id", "split"])
    return slots(out, "features", N_SLOTS, ["record_id", "split", "label", LABEL_COL])


@query
def sink_csv_results(spark, sf):
    report = policy_comparison(spark, sf)
    path = sinks.write_csv(report, scratch_path(spark, "results"))
    return sinks.read_csv(spark, path, report.schema)


@query
def fitted_metadata(spark, sf):
    data = stored_split(spark, sf)
    weights = prepare.class_weights(data.filter("split = 'train'"))
    columns = list(NUMERIC_FEATURES) + [f"{c}_ohe" for c in CATEGORICAL]
    meta = sinks.fitted_metadata(weights, prepare.split_sizes(data), columns)
    return sinks.read_metadata(spark, sinks.write_metadata(meta, scratch_path(spark, "metadata")))


@query
def split_sizes(spark, sf):
    return rounded(prepare.split_sizes(known_split(spark, sf)), ["share"])


@query
def decision_log(spark, sf):
    log = sinks.decision_records(argmax_decisions(spark, sf))
    path = scratch_path(spark, "decisions")
    for part in (log.filter("is_fp"), log.filter("NOT is_fp")):
        sinks.append_decisions(part, path)
    return spark.read.schema(log.schema).parquet(path)


@query
def agent_tables_roundtrip(spark, sf):
    path = sinks.write_agent_tables(learned_q(spark, sf), scratch_path(spark, "agent"))
    return rounded(sinks.read_agent_tables(spark, path), ["q"])


# --- projections and filters ------------------------------------------------------------


@query
def attack_category_map(spark, sf):
    return tables.labelled_records(spark, sf).select("record_id", "attack_type", LABEL_COL)


@query
def drop_leak_columns(spark, sf):
    return prepare.drop_leak_columns(tables.labelled_records(spark, sf))


@query
def numeric_columns(spark, sf):
    lineitem = tables.read_table(spark, sf, "lineitem")
    return lineitem.select(profile.numeric_columns(lineitem))


@query
def filter_known_classes(spark, sf):
    return prepare.filter_known_classes(tables.labelled_records(spark, sf)).select("record_id", LABEL_COL)


@query
def filter_class(spark, sf):
    return prepare.filter_class(tables.labelled_records(spark, sf), "Normal").select("record_id", "service", LABEL_COL)


@query
def preview(spark, sf):
    columns = [c for c, _ in RAW_COLUMNS[:10]] + [LABEL_COL]
    return profile.preview(tables.labelled_records(spark, sf), columns, ["record_id"], 5)


@query
def attach_class_weight(spark, sf):
    a = tables.alerts(spark, sf).withColumn("label", F.col("true_class").cast("double"))
    weights = prepare.class_weights(a, "true_label").withColumnRenamed("true_label", LABEL_COL)
    weighted = prepare.attach_class_weight(a, prepare.class_weight_map(weights))
    return weighted.select("alert_id", "label", "class_weight")


@query
def extract_predictions(spark, sf):
    a = tables.alerts(spark, sf)
    p = F.col("predicted_proba")
    scored = a.select(
        "alert_id",
        F.col("true_label").alias(LABEL_COL),
        F.col("predicted_class").cast("double").alias("prediction"),
        array_to_vector(
            F.array(*[F.when(F.col("predicted_class") == i, p).otherwise((1 - p) / 4) for i in range(len(LABELS))])
        ).alias("probability"),
    )
    return triage.extract_predictions(scored, keep=["alert_id"])


@query
def confidence_bucket(spark, sf):
    return tables.alerts(spark, sf).select("alert_id", fx.confidence_bucket("predicted_proba").alias("confidence"))


@query
def fp_rate_bucket(spark, sf):
    rated = ordered.rolling_fp_rate(argmax_decisions(spark, sf))
    return rated.select("alert_id", fx.fp_rate_bucket("fp_rate_before").alias("fp_bucket"))


@query
def triage_state(spark, sf):
    rated = ordered.rolling_fp_rate(argmax_decisions(spark, sf))
    stated = rated.withColumn("state", fx.triage_state("predicted_class", "predicted_proba", "fp_rate_before"))
    klass, conf, fp = fx.decode_state("state")
    return stated.select("alert_id", "state", klass.alias("klass"), conf.alias("confidence"), fp.alias("fp_bucket"))


@query
def alert_cost(spark, sf):
    gain = fx.reward("action", "true_label")
    return argmax_decisions(spark, sf).select(
        "alert_id", "action", "true_label", gain.alias("reward"), (F.lit(0.0) - gain).alias("cost")
    )


@query
def confusion_role(spark, sf):
    return argmax_decisions(spark, sf).select(
        "alert_id",
        fx.confusion_role("action", "true_label").alias("role"),
        fx.is_false_positive("action", "true_label").alias("is_fp"),
    )


def _policy_query(name: str) -> Query:
    def run(spark, sf):
        acted = triage.with_action(tables.alerts(spark, sf), triage.baseline_policies()[name])
        return acted.select("alert_id", "action", fx.action_name("action").alias("action_name"))

    run.__name__ = f"policy_{name}"
    return query(run)


for _name in ("escalate_all", "threshold", "argmax", "heuristic"):
    _policy_query(_name)


@query
def policy_q_greedy(spark, sf):
    rated = ordered.rolling_fp_rate(argmax_decisions(spark, sf)).drop("action")
    stated = rated.withColumn("state", fx.triage_state("predicted_class", "predicted_proba", "fp_rate_before"))
    return triage.with_greedy_action(stated, learned_q(spark, sf)).select("alert_id", "state", "action")


@query
def policy_epsilon_greedy(spark, sf):
    return argmax_decisions(spark, sf).select(
        "alert_id", fx.epsilon_greedy("alert_id", "action", 0.3, "7").alias("action")
    )


@query
def anomaly_score(spark, sf):
    a = tables.alerts(spark, sf)
    scored = distribution.score_anomalies(a, distribution.calibrate_threshold(a, "error", "true_label"), "error")
    columns = ["alert_id", "anomaly_score", "predicted_anomaly", "scaled_threshold"]
    return rounded(scored.select(columns), ["anomaly_score", "scaled_threshold"])


@query
def simulate_alerts(spark, sf):
    a = tables.alerts(spark, sf).select("alert_id", "true_label", "predicted_class", "predicted_proba")
    return triage.simulate_alerts(a, learned_q(spark, sf), 0.15).drop("predicted_proba")


@query
def cost_table(spark, sf):
    acted = triage.with_action(
        tables.alerts(spark, sf), fx.policy_threshold("predicted_class", "predicted_proba")
    )
    return rounded(triage.situations(acted), ["total_cost"])


# --- joins -----------------------------------------------------------------------------------


@query
def class_shift(spark, sf):
    data = tables.labelled_records(spark, sf).withColumn("external", fx.hash_draw("record_id", "external") < 0.2)
    train = prepare.filter_known_classes(data.filter("NOT external"))
    return profile.class_shift(train, data.filter("external"))


@query
def label_lookup(spark, sf):
    named = prepare.label_lookup(tables.alerts(spark, sf), "predicted_class")
    return named.select("alert_id", "predicted_class", "name")


@query
def policy_comparison(spark, sf):
    return triage.policy_comparison(tables.alerts(spark, sf), triage.baseline_policies(), "all")


@query
def counterfactual_rewards(spark, sf):
    return triage.counterfactual_rewards(tables.alerts(spark, sf)).select("alert_id", "action", "true_label", "reward")


@query
def overfit_check(spark, sf):
    report = metrics.multiclass_metrics(two_models(spark, sf), by=["model", "split"])
    return metrics.overfit_check(report.filter("split = 'val'"), report.filter("split = 'test'"))


@query
def savings_vs_baseline(spark, sf):
    return triage.savings_vs_baseline(policy_comparison(spark, sf))


# --- aggregations ------------------------------------------------------------------------------


@query
def null_profile(spark, sf):
    return profile.null_profile(tables.records(spark, sf), [c for c, _ in RAW_COLUMNS[:-1]])


@query
def class_distribution(spark, sf):
    return profile.class_distribution(tables.labelled_records(spark, sf))


@query
def categorical_profile(spark, sf):
    return profile.categorical_profile(
        tables.read_table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"]
    )


@query
def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(tables.records(spark, sf), PROFILED), ["mean", "stddev"])


@query
def quasi_constant(spark, sf):
    data = tables.records(spark, sf).withColumn("tiny", F.col("same_srv_rate") / 1000).drop("record_id")
    return rounded(profile.quasi_constant(data, profile.profile_numeric_columns(data)), ["std_dev"])


@query
def label_correlation(spark, sf):
    data = tables.labelled_records(spark, sf).drop("record_id")
    return rounded(profile.label_correlation(data, profile.profile_numeric_columns(data)), ["corr", "corr_abs"])


@query
def class_weights(spark, sf):
    return prepare.class_weights(known_split(spark, sf).filter("split = 'train'"))


@query
def class_weight_map(spark, sf):
    return prepare.class_weight_map(class_weights(spark, sf))


@query
def multiclass_metrics(spark, sf):
    return metrics.multiclass_metrics(class_counts(tables.alerts(spark, sf))).drop("f1_macro")


@query
def recall_per_class(spark, sf):
    return metrics.recall_per_class(class_counts(tables.alerts(spark, sf)))


@query
def f1_macro(spark, sf):
    return metrics.multiclass_metrics(class_counts(alert_split(spark, sf), ["split"]), by=["split"]).select(
        "split", "f1_macro"
    )


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(class_counts(tables.alerts(spark, sf)))


@query
def binary_detection_metrics(spark, sf):
    a = tables.alerts(spark, sf)
    scored = distribution.score_anomalies(a, distribution.calibrate_threshold(a, "error", "true_label"), "error")
    return rounded(metrics.binary_detection_metrics(scored, label="true_label"), ["recall", "precision", "f1"])


@query
def calibrate_threshold(spark, sf):
    a = alert_split(spark, sf).filter("split = 'val'")
    return rounded(distribution.calibrate_threshold(a, "error", "true_label"), ["threshold", "max_error"])


@query
def policy_scorecard(spark, sf):
    counts = triage.policy_counts(alert_split(spark, sf), triage.baseline_policies(), ["split"])
    return triage.scorecard(counts, ["policy", "split"])


@query
def accuracy_by_class(spark, sf):
    return rounded(metrics.accuracy_by_class(tables.alerts(spark, sf)), ["accuracy"])


@query
def confidence_histogram(spark, sf):
    h = distribution.class_histogram(tables.alerts(spark, sf), "predicted_label", "predicted_proba", 40)
    return rounded(h, ["bin_left", "bin_right", "density"])


@query
def score_histogram(spark, sf):
    a = tables.alerts(spark, sf)
    scored = distribution.score_anomalies(a, distribution.calibrate_threshold(a, "error", "true_label"), "error")
    h = distribution.class_histogram(scored, "true_label", "anomaly_score", 50)
    return rounded(h, ["bin_left", "bin_right", "density"])


@query
def action_mix_by_class(spark, sf):
    return triage.action_mix_by_class(alert_split(spark, sf).filter("split = 'val'"), learned_q(spark, sf))


@query
def policy_grid(spark, sf):
    return triage.policy_grid(learned_q(spark, sf))


@query
def epoch_history(spark, sf):
    train = alert_split(spark, sf).filter("split = 'train'")
    values = learning.batch_td_epochs(learning.mdp_estimate(learning.transitions(train)), 15)
    return rounded(learning.epoch_history(train, values, epochs=15), ["recall", "epsilon"])


@query
def split_class_pivot(spark, sf):
    return prepare.split_class_pivot(known_split(spark, sf))


@query
def kpi_summary(spark, sf):
    return triage.kpi_summary(known_split(spark, sf), len(FEATURE_COLUMNS))


# --- windows and orders ----------------------------------------------------------------------------


@query
def fp_rate_before(spark, sf):
    return rounded(ordered.rolling_fp_rate(argmax_log(spark, sf)), ["fp_rate_before"]).select(
        "alert_id", "stream_id", "ts", "fp_rate_before"
    )


@query
def fp_rate_after(spark, sf):
    return rounded(ordered.rolling_fp_rate(argmax_log(spark, sf)), ["fp_rate_after"]).select(
        "alert_id", "stream_id", "ts", "fp_rate_after"
    )


@query
def fp_rate_global_halo(spark, sf):
    rated = ordered.rolling_fp_rate(argmax_log(spark, sf), keys=())
    return rounded(rated, ["fp_rate_before", "fp_rate_after"]).select("alert_id", "fp_rate_before", "fp_rate_after")


@query
def best_model(spark, sf):
    report = metrics.model_report(two_models(spark, sf).filter("split = 'val'").drop("split"))
    return metrics.best_model(report)


@query
def best_valid_policy(spark, sf):
    return triage.best_valid_policy(policy_comparison(spark, sf))


@query
def seeded_shuffle(spark, sf):
    return prepare.seeded_shuffle(tables.alerts(spark, sf).select("alert_id", "true_label"), "alert_id", epoch=1)


# --- splits and set operations -------------------------------------------------------------------------


@query
def union_class_parts(spark, sf):
    records = tables.labelled_records(spark, sf).select("record_id", LABEL_COL)
    return prepare.union_parts([prepare.filter_class(records, c) for c in CLASSES])


@query
def stratified_split(spark, sf):
    return known_split(spark, sf).select("record_id", LABEL_COL, "split")


@query
def kfold_assignment(spark, sf):
    train = known_split(spark, sf).filter("split = 'train'")
    return prepare.kfold_assignment(train, "record_id", DEFAULTS.rf_folds).select("record_id", "fold")


@query
def split_overlaps(spark, sf):
    return prepare.split_overlaps(known_split(spark, sf).select("record_id", "split"), "record_id")


#: Attack types that training does not get, so that the external set has unseen ones.
HELD_TYPES = ("satan", "xterm")


def _external(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(training records of known classes, external records of all classes)."""
    data = tables.labelled_records(spark, sf).withColumn("external", fx.hash_draw("record_id", "external") < 0.2)
    train = prepare.filter_known_classes(data.filter("NOT external")).filter(~F.col("attack_type").isin(*HELD_TYPES))
    return train, data.filter("external")


@query
def seen_unseen_recall(spark, sf):
    """Alerts of the external set, and share of them given their own class, by class and whether training had the attack type."""
    train, external = _external(spark, sf)
    marked = prepare.mark_seen(external.select("record_id", "attack_type", LABEL_COL), train, "attack_type")
    alerts = tables.alerts(spark, sf).select(F.col("alert_id").alias("record_id"), "predicted_label")
    hit = (F.col("predicted_label") == F.col(LABEL_COL)).cast("double")
    counts = marked.join(alerts, "record_id").groupBy(LABEL_COL, "seen").agg(F.count("*").alias("n"), F.avg(hit).alias("recall"))
    return rounded(counts, ["recall"])


@query
def external_label_index(spark, sf):
    """Class index of the external rows; a class that training did not have gets the index after the last."""
    train, external = _external(spark, sf)
    model = prepare.label_indexer(unseen="keep").fit(train)
    return model.transform(external).select("record_id", LABEL_COL, "label")


# --- features ----------------------------------------------------------------------------------------------

# values seen in training: 3 protocols, 7 services, 4 flags
ONE_HOT_SLOTS = {"protocol_type": 3, "service": 7, "flag": 4}
N_SLOTS = len(NUMERIC_FEATURES) + sum(ONE_HOT_SLOTS.values())


@query
def label_index(spark, sf):
    data = known_split(spark, sf)
    model = prepare.label_indexer().fit(data.filter("split = 'train'"))
    return model.transform(data).select("record_id", LABEL_COL, "label")


def _encoded(spark, sf, columns: Sequence[str] = ("record_id", *CATEGORICAL, "split")) -> DataFrame:
    data = stored_split(spark, sf, columns)
    stages = [prepare.category_indexer(), prepare.one_hot_encoder()]
    return Pipeline(stages=stages).fit(data.filter("split = 'train'")).transform(data)


@query
def category_index(spark, sf):
    return _encoded(spark, sf).select("record_id", *[f"{c}_idx" for c in CATEGORICAL])


@query
def one_hot(spark, sf):
    arrays = _encoded(spark, sf).select(
        "record_id", *[vector_to_array(f"{c}_ohe").alias(c) for c in CATEGORICAL]
    )
    return arrays.select(
        "record_id", *[F.col(c)[i].alias(f"{c}_{i}") for c in CATEGORICAL for i in range(ONE_HOT_SLOTS[c])]
    )


@query
def assemble_features(spark, sf):
    encoded = _encoded(spark, sf, ["record_id", *NUMERIC_FEATURES, *CATEGORICAL, "split"])
    columns = [*NUMERIC_FEATURES, *[f"{c}_ohe" for c in CATEGORICAL]]
    return slots(prepare.assembler(columns).transform(encoded), "features_raw", N_SLOTS, ["record_id", "split"])


@query
def standardize(spark, sf):
    columns = [*LINEITEM_NUMBERS, "constant"]
    lineitem = spread(tables.read_table(spark, sf, "lineitem").select(*LINEITEM_NUMBERS), "l_extendedprice")
    rows = lineitem.withColumn("constant", F.lit(7.0))
    stages = [prepare.assembler(columns), prepare.scaler()]
    return slots(Pipeline(stages=stages).fit(rows).transform(rows), "features", len(columns), [])


@query
def feature_pipeline(spark, sf):
    model, data = fitted(spark, sf)
    out = prepare.transform_features(model, data, keep=["record_id", "split"])
    return slots(out, "features", N_SLOTS, ["record_id", "split", "label", LABEL_COL])


# --- models ----------------------------------------------------------------------------------------------------


# the published grids (the defaults of the fitting functions) and folds
FOREST_SEARCH = {"folds": DEFAULTS.rf_folds}
BOOSTED_SEARCH = {"folds": DEFAULTS.gbt_folds, "parallelism": 6}

# what was fitted in this session, by kind and version of the table: a search takes minutes and several queries use it
_KEPT: dict[tuple[str, str, str], str] = {}


def _kept(spark, sf, kind, write) -> str:
    """Folder of what ``write(folder)`` makes of the events, written once per session and version of the table."""
    key = (spark.sparkContext.applicationId, sinks.table_version(spark, f"{sf}/events.parquet"), kind)
    if key not in _KEPT or not sinks.exists(spark, _KEPT[key]):
        _KEPT[key] = write(scratch_path(spark, kind))
    return _KEPT[key]


def _features(spark, sf):
    """(fitted feature stages, clean records with split, features of all splits), stored."""

    def write(path):
        data = spark.read.parquet(sinks.write_parquet(known_split(spark, sf), f"{path}/clean", ["split"]))
        model = prepare.fit_features(data.filter("split = 'train'").drop("split"), exclude=["record_id"])
        sinks.save_model(model, f"{path}/stages")
        out = prepare.transform_features(model, data, keep=["record_id", "split"])
        sinks.write_parquet(out, f"{path}/features", ["split"])
        return path

    path = _kept(spark, sf, "features", write)
    return sinks.load_model(f"{path}/stages"), spark.read.parquet(f"{path}/clean"), spark.read.parquet(f"{path}/features")


def _training(spark, sf, folds: int) -> DataFrame:
    """Features of the training rows with weights and folds.

    Weights come from the class counts of the raw training rows, before the assembler drops any.
    """
    model, data, rows = _features(spark, sf)
    weights = prepare.class_weights(data.filter("split = 'train'"))
    by_index = prepare.class_weight_map(weights, labels=prepare.fitted_labels(model))
    train = prepare.attach_class_weight(rows.filter("split = 'train'"), by_index)
    return prepare.kfold_assignment(train, "record_id", folds)


def _forest(spark, sf) -> RandomForestClassificationModel:
    def write(path):
        train = _training(spark, sf, FOREST_SEARCH["folds"])
        return sinks.save_model(models.fit_random_forest(train, fold_col="fold", **FOREST_SEARCH), path)

    return RandomForestClassificationModel.load(_kept(spark, sf, "forest", write))


def _boosted(spark, sf) -> OneVsRestModel:
    def write(path):
        train = _training(spark, sf, BOOSTED_SEARCH["folds"])
        return sinks.save_model(models.fit_gbt_one_vs_rest(train, fold_col="fold", **BOOSTED_SEARCH), path)

    return OneVsRestModel.load(_kept(spark, sf, "boosted", write))


CLASSIFIERS = {"boosted": _boosted, "forest": _forest}


def _predicted(spark, sf, name: str) -> DataFrame:
    """Alerts as the model sees them, on all splits."""
    stages, _, rows = _features(spark, sf)
    scored = models.with_confidence(CLASSIFIERS[name](spark, sf).transform(rows))
    found = triage.extract_predictions(scored, "confidence", keep=["record_id", "split"], labels=prepare.fitted_labels(stages))
    events = tables.alerts(spark, sf).select("alert_id", "stream_id", "ts")
    return triage.alerts_from_predictions(found, "record_id", events).withColumn("model", F.lit(name))


def _prediction_store(spark, sf, *names: str) -> DataFrame:
    """The stored predictions of the named models (all, if none), each written when first asked for."""
    names = names or tuple(CLASSIFIERS)
    path = _kept(spark, sf, "predictions", lambda path: sinks.write_predictions(_predicted(spark, sf, names[0]), path))
    for name in names:
        if not sinks.exists(spark, f"{path}/model={name}"):
            sinks.write_predictions(_predicted(spark, sf, name), path)
    return sinks.read_predictions(spark, path).filter(F.col("model").isin(*names))


def _stored_counts(spark, sf) -> DataFrame:
    held = _prediction_store(spark, sf).filter("split <> 'train'")
    return metrics.confusion_counts(held, "true_class", "predicted_class", ["model", "split"])


@query
def rf_predict(spark, sf):
    stages, _, rows = _features(spark, sf)
    labels = prepare.fitted_labels(stages)
    return triage.extract_predictions(_forest(spark, sf).transform(rows), keep=["record_id", "split"], labels=labels)


def _invariants(predicted: DataFrame, least: float) -> DataFrame:
    """Rows per split and class, how many have a class or probability out of range, and whether the split's
    predictions hit more often than always saying its most frequent class would."""
    odd = ~F.col("predicted_class").between(0, len(LABELS) - 1) | ~F.col("predicted_proba").between(least, 1.0)
    hit = F.col("predicted_label") == F.col("true_label")
    counts = predicted.groupBy("split", "true_label").agg(
        F.count("*").alias("n"), F.count_if(odd).alias("out_of_range"), F.count_if(hit).alias("hits")
    )
    whole = Window.partitionBy("split")
    better = F.sum("hits").over(whole) > F.max("n").over(whole)
    return counts.withColumn("beats_majority", better).drop("hits")


@query
def rf_prediction_invariants(spark, sf):
    return _invariants(rf_predict(spark, sf), 1 / len(LABELS))


@query
def gbt_ovr_predict(spark, sf):
    _, _, rows = _features(spark, sf)
    predicted = F.col("prediction").cast("int").alias("predicted_class")
    return _boosted(spark, sf).transform(rows).select("record_id", "split", LABEL_COL, predicted)


@query
def gbt_prediction_invariants(spark, sf):
    return _invariants(_prediction_store(spark, sf, "boosted"), 0.0)


@query
def feature_importance(spark, sf):
    stages, data, _ = _features(spark, sf)
    return models.feature_importance(_forest(spark, sf), stages.transform(data))


@query
def prediction_store(spark, sf):
    """Rows per model and split of the store, after the forest's part was written a second time."""
    store = _prediction_store(spark, sf)
    path = store.inputFiles()[0].split("/model=")[0]
    sinks.write_predictions(_predicted(spark, sf, "forest"), path)
    return (
        sinks.read_predictions(spark, path)
        .groupBy("model", "split")
        .agg(F.count("*").alias("n"), F.countDistinct("alert_id").alias("n_ids"), F.count_if(F.expr("ts IS NULL OR predicted_label IS NULL")).alias("n_open"))
    )


@query
def fitted_model_report(spark, sf):
    """Metrics and recalls of the stored forest and boosted predictions on validation and test."""
    return metrics.model_report(_stored_counts(spark, sf), by=["model", "split"])


@query
def fitted_best_model(spark, sf):
    return metrics.best_model(fitted_model_report(spark, sf).filter("split = 'val'").drop("split"))


@query
def fitted_overfit_check(spark, sf):
    report = metrics.multiclass_metrics(_stored_counts(spark, sf), by=["model", "split"])
    return metrics.overfit_check(report.filter("split = 'val'"), report.filter("split = 'test'"))


@query
def fitted_policy_scorecard(spark, sf):
    """Scorecard of the baseline policies over the stored predictions of each model, on validation and test."""
    held = _prediction_store(spark, sf).filter("split <> 'train'")
    return triage.scorecard(triage.policy_counts(held, triage.baseline_policies(), ["model", "split"]), ["model", "policy", "split"])


def sides_apart(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` as ``n``, and how many of either side the other does not have; each side is made once."""
    sides = before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(-1)))
    balance = sides.groupBy(before.columns).agg(F.count_if(F.col("_side") == 1).alias("_n"), F.sum("_side").alias("_d"))
    found = {"n": F.col("_n"), "only_before": F.greatest("_d", F.lit(0)), "only_after": F.greatest(-F.col("_d"), F.lit(0))}
    return balance.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in found.items()])


@query
def classifier_roundtrip(spark, sf):
    """Predictions of whole pipelines, feature stages and classifier, before and after saving: rows of only one side."""
    stages, data, _ = _features(spark, sf)
    reports = []
    for name, fitted_model in CLASSIFIERS.items():
        whole = PipelineModel([*stages.stages, fitted_model(spark, sf)])
        again = sinks.load_model(sinks.save_model(whole, scratch_path(spark, name)))
        raw = F.transform(vector_to_array("rawPrediction"), lambda x: F.round(x, 9)).alias("raw")
        before, after = (m.transform(data).select("record_id", "split", "prediction", raw) for m in (whole, again))
        reports.append(sides_apart(before, after).select(F.lit(name).alias("model"), "*"))
    return prepare.union_parts(reports)


def _embedding_rows(spark, sf) -> DataFrame:
    rows = tables.read_table(spark, sf, "embeddings").select(
        "vec_id",
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.when(F.col("label") == 0, "Normal").otherwise(F.concat(F.lit("kind_"), F.col("label"))).alias(LABEL_COL),
    )
    return prepare.stratified_split(rows, "vec_id")


def _detector(spark, sf):
    """(model, calibration, errors of all rows), the errors stored as several reports read them."""
    rows = _embedding_rows(spark, sf)
    model = models.fit_pca_detector(rows.filter("split = 'train'"))
    path = scratch_path(spark, "errors")
    sinks.write_parquet(models.reconstruction_error(model, rows).drop("features"), path)
    errors = spark.read.parquet(path)
    return model, distribution.calibrate_threshold(errors.filter("split = 'val'")), errors


@query
def pca_reconstruction_error(spark, sf):
    rows = _embedding_rows(spark, sf)
    model = models.fit_pca_detector(rows.filter("split = 'train'"))
    return models.reconstruction_error(model, rows).select("vec_id", LABEL_COL, "split", "mse")


@query
def anomaly_detection_report(spark, sf):
    _, calibration, errors = _detector(spark, sf)
    scored = distribution.score_anomalies(errors, calibration)
    return metrics.binary_detection_metrics(scored, by=["split", "threshold"])


@query
def detector_score_histogram(spark, sf):
    """Density of the detector's scores per class."""
    _, calibration, errors = _detector(spark, sf)
    scored = distribution.score_anomalies(errors, calibration)
    return rounded(distribution.class_histogram(scored, LABEL_COL, "anomaly_score", 50), ["bin_left", "bin_right", "density"])


@query
def detector_roundtrip(spark, sf):
    """Scores and flags of the calibrated detector before and after saving: rows per split, and rows of only one side."""
    model, calibration, errors = _detector(spark, sf)
    again, calibrated = sinks.read_detector(spark, sinks.write_detector(model, calibration, scratch_path(spark, "detector")))
    columns = ["vec_id", "split", "mse", "anomaly_score", "predicted_anomaly"]
    scores = (distribution.score_anomalies(errors, calibration), models.anomaly_scores(again, _embedding_rows(spark, sf), calibrated))
    # the last digits of a product depend on the rows of its block
    before, after = (rounded(df.select(columns), ["mse", "anomaly_score"], 9) for df in scores)
    sides = before.withColumn("before", F.lit(1)).unionByName(after.withColumn("before", F.lit(-1)))
    balance = sides.groupBy(columns).agg(F.count_if(F.col("before") == 1).alias("n"), F.sum("before").alias("d"))
    return balance.groupBy("split").agg(
        F.sum("n").alias("n"),
        F.sum(F.greatest("d", F.lit(0))).alias("only_before"),
        F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("only_after"),
    )


# --- learning -------------------------------------------------------------------------------------------------------


@query
def transitions(spark, sf):
    return learning.transitions(tables.alerts(spark, sf))


@query
def mdp_estimate(spark, sf):
    return rounded(learning.mdp_estimate(learning.transitions(tables.alerts(spark, sf))), ["p", "mean_reward"])


@query
def q_iteration(spark, sf):
    return rounded(learned_q(spark, sf), ["q"])


@query
def batch_td_epoch(spark, sf):
    mdp = learning.mdp_estimate(learning.transitions(tables.alerts(spark, sf)))
    return rounded(learning.batch_td_epochs(mdp, 15), ["q"])


@query
def epsilon_schedule(spark, sf):
    # one epoch per day of events
    days = tables.read_table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    epochs = days.withColumn("epoch", F.row_number().over(Window.orderBy("day")))
    return rounded(learning.epsilon_schedule(epochs), ["epsilon"])


# --- streaming ----------------------------------------------------------------------------------------------------------


#: Events of a file, about, and files of a micro-batch, read side by side; one stream's rows of a micro-batch are held in memory.
FILE_ROWS, TRIGGER_FILES = 125_000, 8
LEAST_TRIGGERS = 4


def replay_plan(rows: int) -> tuple[int, int]:
    """(files, files of a micro-batch): every micro-batch costs seconds of its own, so they hold up to a million rows."""
    files = max(LEAST_TRIGGERS, -(-rows // FILE_ROWS))
    return files, min(TRIGGER_FILES, files // LEAST_TRIGGERS)


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts view over a streaming read of ``events``, replayed some files at a time in time order."""
    events = tables.read_table(spark, sf, "events")
    files, at_once = replay_plan(events.count())
    path = _kept(spark, sf, "time-ordered", lambda path: sinks.write_time_ordered(events, path, ["ts", "event_id"], files))
    return tables.alerts_from_events(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", at_once).parquet(path))


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own, as a stream's state keeps the number of partitions it began with.

    Every micro-batch commits all partitions, while the state has few keys (streams, or classes by policies and
    actions): a partition per core, or as many as the given session has if those are fewer.
    """
    session = spark.newSession()
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def _streamed(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = stream.run_to_parquet(df, scratch_path(spark, "stream"), scratch_path(spark, "stream-state"))
    return spark.read.schema(df.schema).parquet(path)


def _argmax_stream(spark: SparkSession, sf: str) -> DataFrame:
    a = stream_alerts(_stream_session(spark), sf)
    return stream.fixed_choices(triage.with_action(a, fx.policy_argmax("predicted_class")))


@query
def stream_last_n(spark, sf):
    return _streamed(spark, stream.stream_decisions(_argmax_stream(spark, sf))).select("alert_id", "stream_id", "kept")


@query
def stream_fp_rate(spark, sf):
    out = _streamed(spark, stream.stream_decisions(_argmax_stream(spark, sf)))
    return rounded(out, ["fp_rate_before", "fp_rate_after"]).select("alert_id", "fp_rate_before", "fp_rate_after")


@query
def stream_window_reset(spark, sf):
    # a new episode every ten days, numbered from the first day of the calendar
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    episodes = _argmax_stream(spark, sf).withColumn("episode_id", F.floor(day / 10))
    out = _streamed(spark, stream.stream_decisions(episodes))
    return rounded(out, ["fp_rate_before"]).select("alert_id", "kept", "fp_rate_before")


@query
def stream_triage(spark, sf):
    session = _stream_session(spark)
    q = sinks.write_agent_tables(learned_q(spark, sf), scratch_path(spark, "agent"))
    acted = triage.with_choices(stream_alerts(session, sf), sinks.read_agent_tables(session, q))
    out = _streamed(spark, stream.stream_decisions(acted))
    return rounded(out, ["fp_rate_before"]).select("alert_id", "stream_id", "fp_rate_before", "action")


@query
def batch_triage(spark, sf):
    acted = triage.with_choices(tables.alerts(spark, sf), learned_q(spark, sf))
    return rounded(stream.batch_decisions(acted), ["fp_rate_before"]).select(
        "alert_id", "stream_id", "fp_rate_before", "action"
    )


def _held_out_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions on the alerts not learned from, per policy and split; the learned policy is fed by its own actions."""
    held = alert_split(spark, sf).filter("split <> 'train'")
    acted = triage.with_choices(held, learned_q(spark, sf))
    decided = prepare.stratified_split(stream.batch_decisions(acted, keys=("split", "stream_id")), "alert_id")
    learned = triage.action_counts(decided, "q_learning", ["split"])
    return triage.policy_counts(held, triage.baseline_policies(), ["split"]).unionByName(learned)


@query
def agent_scorecard(spark, sf):
    """Scorecard of the learned policy next to the baselines, on validation and test."""
    return triage.scorecard(_held_out_counts(spark, sf), ["policy", "split"])


@query
def policy_overfit_check(spark, sf):
    """Change of cost per alert and recall from validation to test, per policy."""
    card = triage.scorecard(_held_out_counts(spark, sf), ["policy", "split"])
    return triage.policy_overfit(card)


@query
def stream_scorecard(spark, sf):
    session = _stream_session(spark)
    counts = stream.stream_policy_counts(stream_alerts(session, sf), triage.baseline_policies())
    name = scratch_path(spark, "counts").rsplit("-", 1)[1]
    table = stream.run_to_memory(counts, f"counts_{name}", scratch_path(spark, "stream-state"))
    return triage.scorecard(table)


@query
def stream_decision_log(spark, sf):
    """Full decision records from a stream, each exactly once: the sink's log skips a batch that is replayed."""
    return _streamed(spark, sinks.decision_records(stream.stream_decisions(_argmax_stream(spark, sf))))


@query
def stream_agent_scorecard(spark, sf):
    """Scorecard of the learned policy, fed by its own actions, from the last state of its running counters."""
    session = _stream_session(spark)
    q = sinks.write_agent_tables(learned_q(spark, sf), scratch_path(spark, "agent"))
    acted = triage.with_choices(stream_alerts(session, sf), sinks.read_agent_tables(session, q))
    history = _streamed(spark, stream.stream_counters(acted))
    return triage.scorecard(stream.latest_counts(history).withColumn("policy", F.lit("q_learning")))
