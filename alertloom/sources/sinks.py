"""Sinks and the readers of what they wrote."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.functions.expressions import is_false_positive, reward
from alertloom.params import DEFAULTS, LABELS, Costs

DECISION_COLUMNS = ("true_label", "predicted_label", "action", "is_fp", "reward", "ts")
METADATA_SCHEMA = "section string, name string, value double"
ANOMALY_META_SCHEMA = "threshold double, max_mse double"
PREDICTION_SCHEMA = (
    "alert_id bigint, stream_id bigint, ts timestamp_ntz, true_class int, true_label string, predicted_class int, "
    "predicted_label string, predicted_proba double, model string, split string"
)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- decision log -----------------------------------------------------------


def decision_records(df: DataFrame, action: str = "action", costs: Costs = DEFAULTS.costs) -> DataFrame:
    """Decision record per alert; keys that order it are kept where present."""
    keys = [c for c in ("alert_id", "stream_id") if c in df.columns]
    return (
        df.withColumn("action", F.col(action).cast("int"))
        .withColumn("is_fp", is_false_positive("action", "true_label"))
        .withColumn("reward", reward("action", "true_label", costs))
        .select(*keys, *DECISION_COLUMNS)
    )


def append_decisions(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def write_time_ordered(df: DataFrame, path: str, order: Sequence[str], files: int) -> str:
    """Rows in about ``files`` files, each later in ``order`` than the one before, for a file stream to replay.

    One range-partitioned job writes them; file streams go by modification time,
    which is then set in the order of the parts.
    """
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    first = int(time.time()) - len(parts)
    for k, part in enumerate(parts):
        store.setTimes(part, (first + k) * 1000, -1)
    return path


# --- fitted metadata ---------------------------------------------------------


def fitted_metadata(weights: DataFrame, sizes: DataFrame, feature_columns: list[str], labels=LABELS) -> DataFrame:
    """Label mapping, class weights, weights by index, feature columns and split sizes as one small table."""
    spark = weights.sparkSession
    named = [("label_mapping", name, float(i)) for i, name in enumerate(labels)]
    named += [("feature_cols", name, float(i)) for i, name in enumerate(feature_columns)]
    fixed = spark.createDataFrame(named, METADATA_SCHEMA)
    index = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("attack_category")) - 1
    by_name = weights.select(
        F.lit("class_weights").alias("section"), F.col("attack_category").alias("name"), F.col("weight").alias("value")
    )
    by_index = weights.filter(index >= 0).select(
        F.lit("weight_map").alias("section"), index.cast("string").alias("name"), F.col("weight").alias("value")
    )
    counts = sizes.select(
        F.lit("n_rows").alias("section"), F.col("split").alias("name"), F.col("n").cast("double").alias("value")
    )
    return fixed.unionByName(by_name).unionByName(by_index).unionByName(counts)


def write_metadata(metadata: DataFrame, path: str) -> str:
    metadata.write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(path)


# --- triage table and detector metadata ---------------------------------------


def write_agent_tables(q_table: DataFrame, path: str) -> str:
    return write_parquet(q_table.select("state", "action", "q"), path)


def read_agent_tables(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("state int, action int, q double").parquet(path)


def write_calibration(calibration: DataFrame, path: str) -> str:
    """One row: threshold and greatest error of the detector."""
    return write_parquet(calibration.select("threshold", F.col("max_error").alias("max_mse")), path)


def read_calibration(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANOMALY_META_SCHEMA).parquet(path).withColumnRenamed("max_mse", "max_error")


def write_anomaly_meta(spark: SparkSession, threshold: float, max_mse: float, path: str) -> str:
    """The same from known numbers."""
    row = spark.range(1).select(F.lit(threshold).cast("double").alias("threshold"), F.lit(max_mse).cast("double").alias("max_error"))
    return write_calibration(row, path)


def read_anomaly_meta(spark: SparkSession, path: str) -> tuple[float, float]:
    row = read_calibration(spark, path).first()
    return row.threshold, row.max_error


def write_detector(model: PipelineModel, calibration: DataFrame, path: str) -> str:
    """Center and components with the calibrated threshold and maximum, as one unit."""
    save_model(model, f"{path}/model")
    write_calibration(calibration, f"{path}/calibration")
    return path


def read_detector(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return load_model(f"{path}/model"), read_calibration(spark, f"{path}/calibration")


# --- prediction store ----------------------------------------------------------


def write_predictions(df: DataFrame, path: str) -> str:
    """Predictions by (model, split). Writing again replaces only the parts that ``df`` has."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("model", "split").parquet(path)
    return path


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions as alerts, with their model and split."""
    return spark.read.schema(PREDICTION_SCHEMA).parquet(path)


# --- versions of inputs ----------------------------------------------------------


def table_version(spark: SparkSession, path: str) -> str:
    """Changes with the files below ``path``: their names, lengths and times. Reads no content."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    row = files.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(path, length, modificationTime))").alias("h")).first()
    return f"{row.n}-{row.h}"
