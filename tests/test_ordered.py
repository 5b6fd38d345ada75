"""Decision windows: plain, chunked and brute force agree, also under skew."""

from collections import deque

import pytest
from pyspark.sql import functions as F

from alertloom.operators import ordered
from alertloom.params import DEFAULTS


def decisions(spark, lengths):
    """Streams of the given lengths; many rows share a timestamp, so the id decides."""
    sizes = spark.createDataFrame([(k, n) for k, n in enumerate(lengths) if n], "stream_id long, n int")
    rows = sizes.withColumn("i", F.explode(F.sequence(F.lit(1), "n")))
    key = F.concat_ws("-", "stream_id", "i")
    h = F.pmod(F.xxhash64(key), F.lit(6))
    return rows.select(
        (F.col("stream_id") * 100000 + F.col("i")).alias("alert_id"),
        "stream_id",
        F.timestamp_seconds(F.floor(F.col("i") / 7)).alias("ts"),
        (h % 3).cast("int").alias("action"),
        F.when(h >= 3, "Normal").otherwise("DoS").alias("true_label"),
    )


def brute_force(rows, keys, window=DEFAULTS.window):
    seen, out = {}, {}
    for r in sorted(rows, key=lambda r: (r.ts, r.alert_id)):
        buf = seen.setdefault(tuple(r[k] for k in keys), deque(maxlen=window))

        def rate():
            esc = [x for x in buf if x[0] == 2]
            return sum(x[1] == "Normal" for x in esc) / len(esc) if esc else 0.0

        before = rate()
        buf.append((r.action, r.true_label))
        out[r.alert_id] = (before, rate())
    return out


def rates(df):
    return {r.alert_id: (r.fp_rate_before, r.fp_rate_after) for r in df.collect()}


LENGTHS = [0, 1, 100, 101, 250, 1200]


@pytest.mark.parametrize("keys", [("stream_id",), ()], ids=["per stream", "global"])
@pytest.mark.parametrize("chunk_rows", [100, 130, 100_000])
def test_equals_brute_force(spark, keys, chunk_rows):
    df = decisions(spark, LENGTHS).cache()
    got = rates(ordered.rolling_fp_rate(df, keys, chunk_rows=chunk_rows))
    assert got == brute_force(df.collect(), keys) and len(got) == sum(LENGTHS)


def test_a_hot_stream_is_cut_and_no_job_is_started(spark):
    df = decisions(spark, [50, 30, 4000, 20]).cache()
    expected = brute_force(df.collect(), ("stream_id",))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    rated = ordered.rolling_fp_rate(df, chunk_rows=500)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext._jsc.clearJobGroup()
    assert rates(rated) == expected
    rows = ordered.with_halo(ordered.positioned(df, ["stream_id"], ["ts", "alert_id"]), 100, 500)
    assert max(r["count"] for r in rows.groupBy("_key", "_chunk").count().collect()) <= 600


def test_positions_count_up_within_keys(spark):
    df = decisions(spark, [7, 0, 900]).unionByName(decisions(spark, [5]).withColumn("stream_id", F.lit(None).cast("long")))
    for ts in ("timestamp", "timestamp_ntz"):
        rows = ordered.positioned(df.withColumn("ts", F.col("ts").cast(ts)), ["stream_id"], ["ts", "alert_id"], 10).collect()
        found = {}
        for r in sorted(rows, key=lambda r: (str(r.stream_id), r.ts, r.alert_id)):
            found.setdefault(r.stream_id, []).append(r._pos)
        assert {k: v == list(range(len(v))) for k, v in found.items()} == {0: True, 2: True, None: True}


def test_window_of_one_and_no_history(spark):
    df = decisions(spark, [5])
    got = rates(ordered.rolling_fp_rate(df, window=1))
    assert got == brute_force(df.collect(), ("stream_id",), 1)
    assert got[1][0] == 0.0


def test_one_timestamp_for_all_rows(spark):
    df = decisions(spark, [900]).withColumn("ts", F.timestamp_seconds(F.lit(5))).cache()
    got = rates(ordered.rolling_fp_rate(df, (), chunk_rows=100))
    assert got == brute_force(df.collect(), ())


@pytest.mark.parametrize("keys", [("stream_id",), ()], ids=["per stream", "global"])
def test_several_actions_over_one_shuffle(spark, keys):
    df = decisions(spark, LENGTHS).cache()
    actions = [F.col("action"), F.when(F.col("alert_id") % 3 == 0, 2).otherwise(F.col("action"))]
    chosen = F.when(F.col("run") == 1, actions[0]).otherwise(actions[1])
    rated = ordered.rolling_fp_rates(df, 2, chosen, keys, chunk_rows=130)
    for i, action in enumerate(actions, 1):
        expected = brute_force(df.withColumn("action", action).collect(), keys)
        assert rates(rated.filter(F.col("run") == i)) == expected
    assert ordered.rolling_fp_rates(df.limit(0), 2, chosen, keys).count() == 0


def test_runs_are_multiplied_behind_the_shuffle(spark):
    rated = ordered.rolling_fp_rates(decisions(spark, LENGTHS), 15, F.col("action"))
    plan = rated._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate explode(", 1)
    assert "[run#" in below.split("\n")[0] and "Exchange" not in above and below.count("Exchange") >= 3
