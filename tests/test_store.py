"""The prediction store, reports over it against SQL on its files, saved detectors, and split checks."""

import duckdb
import pytest
from pyspark.sql import functions as F

from alertloom.operators import prepare
from alertloom.params import LABELS
from alertloom.plans import catalog
from alertloom.session import scratch_path
from alertloom.sources import sinks


@pytest.fixture(scope="module")
def store(spark, sf_dir):
    df = catalog._prediction_store(spark, sf_dir)
    path = df.inputFiles()[0].split("/model=")[0].removeprefix("file:").replace("///", "/")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW store AS SELECT * FROM read_parquet('{path}/*/*/*.parquet', hive_partitioning = true)")
    con.execute("CREATE VIEW held AS SELECT * FROM store WHERE split <> 'train'")
    return con


def test_model_report(spark, sf_dir, store):
    got = {(r.model, r.split): r for r in catalog.QUERIES["fitted_model_report"](spark, sf_dir).collect()}
    assert set(got) == {(m, s) for m in ("boosted", "forest") for s in ("val", "test")}
    rows = store.execute("SELECT model, split, round(avg((true_class = predicted_class)::INT), 4) FROM held GROUP BY ALL").fetchall()
    assert {(m, s): a for m, s, a in rows} == {k: r.accuracy for k, r in got.items()}
    for i, name in enumerate(LABELS):
        recalls = store.execute(
            f"SELECT model, split, coalesce(round(avg((predicted_class = {i})::INT) FILTER (true_class = {i}), 4), 0) FROM held GROUP BY ALL"
        ).fetchall()
        assert {(m, s): a for m, s, a in recalls} == {k: r[f"recall_{name}"] for k, r in got.items()}


F1 = """
WITH c AS (SELECT model, split, k, count(*) FILTER (true_class = k AND predicted_class = k) AS hit,
                  count(*) FILTER (true_class = k) AS actual, count(*) FILTER (predicted_class = k) AS said
           FROM held, range(5) t(k) GROUP BY ALL)
SELECT model, split, round(avg(2.0 * hit / (actual + said)) FILTER (actual + said > 0), 4) AS f1 FROM c GROUP BY ALL
"""


def test_best_model_and_drop(spark, sf_dir, store):
    f1 = {(m, s): v for m, s, v in store.execute(F1).fetchall()}
    best = catalog.QUERIES["fitted_best_model"](spark, sf_dir).collect()
    assert [(r.model, r.f1_macro) for r in best] == [min(((m, v) for (m, s), v in f1.items() if s == "val"), key=lambda x: (-x[1], x[0]))]
    drops = {r.model: (r.val, r.test, r.overfit) for r in catalog.QUERIES["fitted_overfit_check"](spark, sf_dir).collect()}
    assert drops == {m: (f1[m, "val"], f1[m, "test"], f1[m, "val"] - f1[m, "test"] > 0.05) for m in ("boosted", "forest")}


def test_policy_scorecard(spark, sf_dir, store):
    cost = """
SELECT model, split, sum(CASE WHEN predicted_class = 1 THEN CASE true_label WHEN 'Normal' THEN -1 WHEN 'DoS' THEN 20 ELSE 15 END
                              ELSE 1 + CASE true_label WHEN 'Normal' THEN 2 ELSE 0 END END) AS cot,
       sum((predicted_class <> 1 AND true_label <> 'Normal')::INT)::DOUBLE / sum((true_label <> 'Normal')::INT) AS recall
FROM held GROUP BY ALL"""
    want = {(m, s): (c, round(r, 4)) for m, s, c, r in store.execute(cost).fetchall()}
    rows = catalog.QUERIES["fitted_policy_scorecard"](spark, sf_dir).filter("policy = 'argmax'").collect()
    assert {(r.model, r.split): (r.COT, r.recall_sistema) for r in rows} == want


def test_writing_again_replaces_only_its_part(spark):
    path = scratch_path(spark, "store")
    rows = spark.range(6).select(
        F.col("id").alias("alert_id"),
        F.lit(1).cast("bigint").alias("stream_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        *[F.lit(1).alias(c) for c in ("true_class", "predicted_class")],
        *[F.lit("Normal").alias(c) for c in ("true_label", "predicted_label")],
        F.lit(0.5).alias("predicted_proba"),
        F.when(F.col("id") < 3, "a").otherwise("b").alias("model"),
        F.when(F.col("id") % 2 == 0, "val").otherwise("test").alias("split"),
    )
    sinks.write_predictions(rows, path)
    sinks.write_predictions(rows.filter("model = 'a' AND split = 'val'").withColumn("predicted_proba", F.lit(0.9)), path)
    got = {(r.alert_id, r.model, r.split, r.predicted_proba) for r in sinks.read_predictions(spark, path).collect()}
    assert got == {(i, "a" if i < 3 else "b", "val" if i % 2 == 0 else "test", 0.9 if i in (0, 2) else 0.5) for i in range(6)}
    assert sinks.read_predictions(spark, path).count() == 6


def test_version_follows_the_files(spark):
    path = scratch_path(spark, "versioned")
    spark.range(5).write.parquet(path)
    first = sinks.table_version(spark, path)
    assert first == sinks.table_version(spark, path)
    spark.range(5).write.mode("append").parquet(path)
    assert sinks.table_version(spark, path) != first


def test_changed_table_is_fitted_anew(spark, monkeypatch):
    path = scratch_path(spark, "sf")
    written = []

    def write(folder):
        written.append(folder)
        return sinks.write_parquet(spark.range(1), folder)

    spark.range(3).write.parquet(f"{path}/events.parquet")
    assert catalog._kept(spark, path, "unit", write) == catalog._kept(spark, path, "unit", write)
    spark.range(3).write.mode("append").parquet(f"{path}/events.parquet")
    catalog._kept(spark, path, "unit", write)
    assert len(written) == 2


def test_split_checks_find_what_is_wrong(spark):
    rows = spark.createDataFrame([(1, "train"), (1, "val"), (2, "val"), (2, "val"), (3, "else"), (None, "test")], "k int, split string")
    got = {r.check: r.n for r in prepare.split_overlaps(rows, "k").collect()}
    assert got == {"train & val": 1, "train & test": 0, "val & test": 0, "missing": 1, "repeated": 2}


def test_seen_values(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    rows = spark.createDataFrame([(1, "a"), (2, "z"), (3, None), (4, "a")], "id int, t string")
    got = sorted((r.id, r.seen) for r in prepare.mark_seen(rows, train, "t").collect())
    assert got == [(1, True), (2, False), (3, False), (4, True)]


def test_sides_of_a_roundtrip_are_counted_with_repeats(spark):
    schema = "id int, raw array<double>"
    before = spark.createDataFrame([(1, [0.5]), (1, [0.5]), (2, [0.1, 0.2]), (None, None)], schema)
    after = spark.createDataFrame([(1, [0.5]), (2, [0.1, 0.3]), (None, None), (3, None)], schema)
    assert tuple(catalog.sides_apart(before, after).first()) == (4, before.exceptAll(after).count(), after.exceptAll(before).count()) == (4, 2, 2)
    assert tuple(catalog.sides_apart(before.limit(0), after.limit(0)).first()) == (0, 0, 0)
