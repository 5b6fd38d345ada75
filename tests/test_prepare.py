"""Loading, cleaning, splitting and the feature pipeline."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from records import record_rows, write_csv

from alertloom.operators import prepare, profile
from alertloom.params import CATEGORICAL, FEATURE_COLUMNS, LABEL_COL, NUMERIC_FEATURES, RAW_COLUMNS
from alertloom.session import spread
from alertloom.sources import sinks, tables


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = write_csv(tmp_path_factory.mktemp("raw") / "records.txt", record_rows())
    return tables.read_labelled_records(spark, path).cache()


def test_positional_records_have_the_pinned_types(raw):
    assert raw.dtypes == [*RAW_COLUMNS, (LABEL_COL, "string")]
    assert raw.count() == 200
    assert {r[0] for r in raw.select(LABEL_COL).distinct().collect()} == {"Normal", "DoS", "Probe", "R2L", "U2R", "Unknown"}


def test_null_profile_and_constant_columns(raw):
    assert {r.column: r.null_count for r in profile.null_profile(raw).collect()} == {"src_bytes": 8, "same_srv_rate": 8}
    constant = profile.quasi_constant(raw, profile.profile_numeric_columns(raw)).collect()
    assert [(r.column, r.std_dev) for r in constant] == [("num_outbound_cmds", 0.0)]


def test_numeric_selection_by_type_and_by_exclusion(raw):
    assert profile.profile_numeric_columns(raw) == list(NUMERIC_FEATURES)
    clean = prepare.drop_leak_columns(raw)
    assert clean.columns == [*FEATURE_COLUMNS, LABEL_COL]
    assert prepare.feature_columns(clean) == [*NUMERIC_FEATURES, *[f"{c}_ohe" for c in CATEGORICAL]]


def test_correlation_matches_spark_and_skips_constants(spark, raw):
    columns = list(NUMERIC_FEATURES)
    got = {r.column: r.corr for r in profile.label_correlation(raw, columns, top=100).collect()}
    from pyspark.ml.feature import StringIndexer

    indexed = StringIndexer(inputCol=LABEL_COL, outputCol="y").fit(raw).transform(raw)
    usable = [c for c in columns if c != "num_outbound_cmds"]
    expected = indexed.agg(*[F.corr(c, "y").alias(c) for c in usable]).first().asDict()
    assert set(got) == set(usable)
    for c in usable:
        assert got[c] == pytest.approx(expected[c], abs=1e-9)


def test_class_shift_fills_missing_classes(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)], f"{LABEL_COL} string")
    test = spark.createDataFrame([("b",)] + [("c",)], f"{LABEL_COL} string")
    got = {r[0]: tuple(r)[1:] for r in profile.class_shift(train, test).collect()}
    assert got == {"a": (3, 0, 75.0, 0.0, -75.0), "b": (1, 1, 25.0, 50.0, 25.0), "c": (0, 1, 0.0, 50.0, 50.0)}


def test_only_training_data_loses_unknown_classes(raw):
    known = prepare.filter_known_classes(raw)
    assert known.filter(F.col(LABEL_COL) == "Unknown").count() == 0
    assert known.count() == raw.filter(F.col(LABEL_COL) != "Unknown").count() < raw.count()


def test_split_is_complete_disjoint_and_independent_of_partitioning(spark):
    df = spark.range(20000).withColumn("c", F.when(F.col("id") % 3 == 0, "x").otherwise("y"))
    one = prepare.stratified_split(df.repartition(1), "id")
    many = prepare.stratified_split(df.repartition(11), "id")
    assert one.exceptAll(many).count() == 0
    parts = prepare.split_parts(one)
    assert sum(p.count() for p in parts) == 20000
    for i in range(3):
        for j in range(i):
            assert parts[i].select("id").intersect(parts[j].select("id")).count() == 0
    shares = one.groupBy("c").agg(*[F.avg((F.col("split") == s).cast("int")).alias(s) for s in prepare.SPLITS]).collect()
    for r in shares:
        assert (r.train, r.val, r.test) == pytest.approx((0.70, 0.15, 0.15), abs=0.015)


def test_folds_cover_all_rows_evenly(spark):
    folds = prepare.kfold_assignment(spark.range(10000), "id", 5).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == set(range(5)) and all(1850 < r["count"] < 2150 for r in folds)


def test_shuffle_order_depends_on_seed_and_epoch_only(spark):
    df = spark.range(300)
    order = lambda d, **kw: [r.id for r in prepare.seeded_shuffle(d, "id", **kw).collect()]
    first = order(df.repartition(3))
    assert first == order(df.repartition(9)) and sorted(first) == list(range(300))
    assert first != order(df, epoch=1) and first != order(df, seed=7)


def test_weights_are_looked_up_by_index_with_default_one(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (4.0,)], "label double")
    weights = spark.createDataFrame([(0, 2.5), (1, 0.5)], "label int, weight double")
    got = {r.label: r.class_weight for r in prepare.attach_class_weight(rows, weights).collect()}
    assert got == {0.0: 2.5, 1.0: 0.5, 4.0: 1.0}


# --- feature pipeline ------------------------------------------------------------


@pytest.fixture(scope="module")
def features(spark, raw, tmp_path_factory):
    train = prepare.drop_leak_columns(prepare.filter_known_classes(raw))
    path = write_csv(tmp_path_factory.mktemp("raw") / "test.txt", record_rows(40, seed=9, unmapped=(), nulls=False, service="gopher"))
    test = prepare.drop_leak_columns(tables.read_labelled_records(spark, path))
    return train, test, prepare.fit_features(train)


def dense(df):
    rows = df.select(vector_to_array("features").alias("a"), "label", LABEL_COL).collect()
    return np.array([r.a for r in rows]), [r.label for r in rows]


def test_features_are_standardized_with_training_statistics(features):
    train, _, model = features
    x, labels = dense(prepare.transform_features(model, train))
    n_known = train.dropna(subset=list(NUMERIC_FEATURES)).count()
    assert x.shape[0] == n_known < train.count()  # rows with a null feature are dropped
    constant = list(NUMERIC_FEATURES).index("num_outbound_cmds")
    others = [i for i in range(x.shape[1]) if i != constant]
    assert np.all(x[:, constant] == 0.0)
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x[:, others].std(axis=0, ddof=1), 1)
    assert set(labels) == {0.0, 1.0, 2.0, 3.0, 4.0} and prepare.fitted_labels(model) == ["DoS", "Normal", "Probe", "R2L", "U2R"]


def test_unseen_category_gives_an_all_zero_block(features):
    train, test, model = features
    out = model.transform(test)
    assert out.count() == 40
    block = out.select(vector_to_array("service_ohe").alias("b")).distinct().collect()
    assert [r.b for r in block] == [[0.0, 0.0, 0.0]]


def test_unseen_label_is_an_error(features):
    train, test, model = features
    odd = test.withColumn(LABEL_COL, F.lit("Unknown"))
    with pytest.raises(Exception, match="Unseen label"):
        prepare.transform_features(model, odd).collect()


def test_saved_pipeline_gives_the_same_rows(spark, features, tmp_path):
    train, test, model = features
    again = sinks.load_model(sinks.save_model(model, str(tmp_path / "p")))
    a, _ = dense(prepare.transform_features(model, test))
    b, _ = dense(prepare.transform_features(again, test))
    assert np.array_equal(np.sort(a, axis=0), np.sort(b, axis=0))


def test_metadata_and_detector_tables_roundtrip(spark, raw, tmp_path):
    split = prepare.stratified_split(prepare.filter_known_classes(raw).withColumn("id", F.monotonically_increasing_id()), "id")
    meta = sinks.fitted_metadata(prepare.class_weights(split), prepare.split_sizes(split), list(FEATURE_COLUMNS))
    back = sinks.read_metadata(spark, sinks.write_metadata(meta, str(tmp_path / "m")))
    assert back.exceptAll(meta).count() == 0 and back.count() == meta.count()
    path = sinks.write_anomaly_meta(spark, 0.5, 9.25, str(tmp_path / "d"))
    assert sinks.read_anomaly_meta(spark, path) == (0.5, 9.25)


def test_category_profile_is_one_scan_with_a_pushed_down_rank(spark, sf_dir):
    df = tables.read_table(spark, sf_dir, "lineitem")
    plan = profile.categorical_profile(df, ["l_returnflag", "l_suppkey"])
    rows = plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text and "WindowGroupLimit" in text
    assert len([r for r in rows if r.column == "l_suppkey"]) == 10


def test_scan_reads_only_the_needed_columns(spark, sf_dir):
    df = tables.read_table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select("l_tax")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in text and "GreaterThan(l_quantity,40.0)" in text


def test_small_inputs_are_spread_and_large_ones_left_alone(spark):
    assert spread(spark.range(0, 100, 1, 1), "id").count() == 100
    assert "Exchange" in spread(spark.range(0, 100, 1, 1), "id")._jdf.queryExecution().executedPlan().toString()
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide, "id") is wide


def test_attack_types_have_their_published_category(spark):
    """A fixed expectation, apart from the table the library uses."""
    expected = {
        "normal": "Normal", "neptune": "DoS", "smurf": "DoS", "udpstorm": "DoS", "satan": "Probe", "saint": "Probe",
        "guess_passwd": "R2L", "worm": "R2L", "rootkit": "U2R", "xterm": "U2R", "mystery": "Unknown",
    }
    from alertloom.functions.expressions import attack_category

    rows = spark.createDataFrame([(t,) for t in expected], "attack_type string")
    assert {r[0]: r[1] for r in rows.select("attack_type", attack_category("attack_type")).collect()} == expected


def test_owned_scratch_is_removed(spark):
    import os

    from alertloom.session import owned_scratch, scratch_path

    with owned_scratch(spark):
        path = scratch_path(spark, "owned")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert not os.path.exists(path.removeprefix("file:"))


def test_split_checks_read_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "keys")
    rows = [(1, "train"), (1, "val"), (2, "val"), (2, "val"), (3, "test"), (3, "train"), (3, "val"), (4, None), (4, "train"), (5, "odd"), (None, "test"), (None, "val"), (6, "test")]
    spark.createDataFrame(rows, "k int, split string").write.parquet(path)
    checks = prepare.split_overlaps(spark.read.parquet(path), "k")
    assert {r.check: r.n for r in checks.collect()} == {"train & val": 2, "train & test": 1, "val & test": 2, "missing": 2, "repeated": 5}
    assert checks._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    none = prepare.split_overlaps(spark.read.parquet(path).filter("k > 9"), "k")
    assert {r.n for r in none.collect()} == {0}


def test_record_filters_stay_behind_the_shuffle_and_tasks_are_bounded(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tables, "RECORD_TASK_ROWS", 30)
    known = prepare.filter_known_classes(tables.labelled_records(spark, sf_dir))
    events = tables.read_table(spark, sf_dir, "events").count()
    assert known.rdd.getNumPartitions() == -(-events // 30)
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "Filter" not in plan[plan.index("RepartitionByExpression") :]


def test_sessions_of_others_get_the_limit_for_generated_methods(spark, sf_dir):
    session = spark.newSession()
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    tables.records(session, sf_dir)
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
