"""Exact percentiles and histograms against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertloom.operators import distribution


def table(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)


RNG = np.random.default_rng(5)
SAMPLES = {
    "uniform": RNG.random(5000),
    "long tail": RNG.lognormal(0, 3, 5000),
    "ties at the rank": np.concatenate([RNG.random(2000), np.full(3000, 0.9)]),
    "one value": np.full(400, 3.25),
    "two values": np.array([1.0] * 950 + [2.0] * 50),
    "tie then neighbor": np.array([0.0] * 3000 + [5.0] * 951 + [9.0] * 49),
    "single row": np.array([4.5]),
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_percentile(spark, name, p):
    got = table(spark, SAMPLES[name]).agg(distribution.percentile(F.col("x"), p)).first()[0]
    assert got == pytest.approx(np.percentile(SAMPLES[name], p * 100), rel=1e-12)


@pytest.mark.parametrize("name", ["uniform", "long tail", "ties at the rank"])
@pytest.mark.parametrize("accuracy", [20, 1000])
def test_approximate_percentile_is_off_by_few_ranks(spark, name, accuracy):
    values = np.sort(SAMPLES[name])
    got = table(spark, values).agg(distribution.percentile(F.col("x"), 0.95, accuracy)).first()[0]
    slack = len(values) / accuracy + 1
    assert np.searchsorted(values, got, "left") - slack <= 0.95 * len(values) <= np.searchsorted(values, got, "right") + slack


def test_percentile_ignores_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "x double")
    assert df.agg(distribution.percentile(F.col("x"), 0.5)).first()[0] == 2.0
    assert df.filter("x is null").agg(distribution.percentile(F.col("x"), 0.5)).first()[0] is None


def test_calibration_uses_normal_rows_for_the_threshold_and_all_for_the_maximum(spark):
    rows = [("Normal", float(i)) for i in range(101)] + [("DoS", 500.0)]
    df = spark.createDataFrame(rows, "attack_category string, mse double")
    calibration = distribution.calibrate_threshold(df)
    assert tuple(calibration.first()) == (95.0, 500.0)
    scored = distribution.score_anomalies(df, calibration)
    assert scored.filter("predicted_anomaly").count() == 6  # strictly above
    assert scored.first().scaled_threshold == pytest.approx(0.19)


def test_no_normal_row_gives_null_flags(spark):
    df = spark.createDataFrame([("DoS", 5.0)], "attack_category string, mse double")
    scored = distribution.score_anomalies(df, distribution.calibrate_threshold(df)).first()
    assert scored.predicted_anomaly is None and scored.threshold is None and scored.anomaly_score == pytest.approx(1.0)


def test_histogram_matches_numpy(spark):
    groups = {"a": RNG.normal(size=700), "b": RNG.random(300) * 40, "flat": np.full(5, 2.0)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double")
    out = distribution.class_histogram(df, "g", "x", 20).orderBy("g", "bin").collect()
    for g, values in groups.items():
        counts, edges = np.histogram(values, bins=20)
        density, _ = np.histogram(values, bins=20, density=True)
        mine = [r for r in out if r.g == g]
        assert [r.n for r in mine] == list(counts)
        assert [r.bin_left for r in mine] == pytest.approx(list(edges[:-1]))
        assert mine[-1].bin_right == pytest.approx(edges[-1])
        assert [r.density for r in mine] == pytest.approx(list(density))
