"""Percentiles, histograms and the anomaly score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.functions.expressions import anomaly_score
from alertloom.params import LABEL_COL, NORMAL

def percentile(column: Column, p: float, accuracy: int | None = None) -> Column:
    """Percentile of a column as an aggregate.

    Exact with linear interpolation; with ``accuracy`` an approximate one whose
    rank is off by at most rows / accuracy, for columns with more distinct values
    than a task can hold.
    """
    return F.percentile(column, p) if accuracy is None else F.percentile_approx(column, p, accuracy).cast("double")


# --- anomaly ------------------------------------------------------------------


def calibrate_threshold(
    df: DataFrame,
    error: str = "mse",
    label: str = LABEL_COL,
    normal: str = NORMAL,
    p: float = 0.95,
    accuracy: int | None = None,
) -> DataFrame:
    """One row ``threshold, max_error``: percentile of the error over normal rows, maximum over all rows.

    One lazy pass. Without a normal row the threshold is null.
    """
    value = F.col(error).cast("double")
    return df.agg(
        percentile(F.when(F.col(label) == normal, value), p, accuracy).alias("threshold"), F.max(value).alias("max_error")
    )


def score_anomalies(df: DataFrame, calibration: DataFrame, error: str = "mse") -> DataFrame:
    """Error scaled by the calibrated maximum, the threshold on that scale, and the flag for errors above it.

    ``calibration`` is the one row of ``calibrate_threshold``. A null threshold gives null flags.
    """
    return (
        df.crossJoin(F.broadcast(calibration))
        .withColumn("anomaly_score", anomaly_score(error, F.col("max_error")))
        .withColumn("scaled_threshold", anomaly_score("threshold", F.col("max_error")))
        .withColumn("predicted_anomaly", F.col(error) > F.col("threshold"))
        .drop("max_error")
    )


# --- histograms ---------------------------------------------------------------


def class_histogram(df: DataFrame, by: str, value: str, bins: int) -> DataFrame:
    """Equal-width density histogram per group over the group's own range.

    All bins are returned, the last one closed on the right. A group with a
    single value gets the range value - 0.5 .. value + 0.5.
    """
    clean = df.select(F.col(by), F.col(value).cast("double").alias("x")).filter("x is not null")
    # a row per class, so it may be broadcast
    ranges = F.broadcast(clean.groupBy(by).agg(F.count("*").alias("rows"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        F.col(by).alias("_by"),
        "rows",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        clean.join(ranges, F.col(by) == F.col("_by"))
        .groupBy("_by", F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, ["_by", "bin"], "left").select(
        F.col("_by").alias(by),
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_left"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_right"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) / (F.col("rows") * width)).alias("density"),
    )
