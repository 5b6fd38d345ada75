"""Feedback triage: streaming, parallel batch and a plain loop agree."""

import os
import random

import pytest
from pyspark.sql import functions as F

from alertloom.operators import triage
from alertloom.params import FP_RATE_CUTS, NORMAL
from alertloom.sources import sinks
from alertloom.streaming import triage as stream

SCHEMA = "alert_id long, stream_id long, ts timestamp_ntz, episode_id long, true_label string, choice_0 int, choice_1 int, choice_2 int"


def make(spark, lengths, seed=3):
    """Choices that react to the false-positive rate, so an error would spread."""
    rng = random.Random(seed)
    rows = []
    for s, n in enumerate(lengths):
        for i in range(n):
            label = rng.choice([NORMAL, NORMAL, "DoS", "U2R"])
            rows.append((s * 1_000_000 + i, s, i // 3, 0, label, rng.choice([2, 2, 1]), rng.choice([2, 0, 0, 2]), rng.choice([0, 1, 0, 2])))
    schema = SCHEMA.replace("timestamp_ntz", "int")
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz")).select(*[c.split()[0] for c in SCHEMA.split(", ")])


def loop(rows, window=100, keys=("stream_id",), episodes=False):
    """Plain re-computation of the window at every step."""
    history, out = {}, {}
    for r in sorted(rows, key=lambda r: (r.ts, r.alert_id)):
        key = tuple(r[k] for k in keys)
        past = history.setdefault(key, [])
        if episodes and past and past[-1][2] != r.episode_id:
            past.clear()

        def rate():
            esc = [x for x in past[-window:] if x[0] == 2]
            return sum(x[1] == NORMAL for x in esc) / len(esc) if esc else 0.0

        before = rate()
        bucket = 0 if before < FP_RATE_CUTS[0] else 1 if before < FP_RATE_CUTS[1] else 2
        action = r[f"choice_{bucket}"]
        past.append((action, r.true_label, r.episode_id))
        out[r.alert_id] = (min(len(past), window), before, rate(), action)
    return out


def result(df):
    return {r.alert_id: (r.kept, r.fp_rate_before, r.fp_rate_after, r.action) for r in df.collect()}


LENGTHS = [0, 1, 100, 101, 250, 1500]


@pytest.mark.parametrize("chunk_rows", [5000, 230, 100])
def test_batch_equals_the_loop_whatever_the_chunks(spark, chunk_rows):
    df = make(spark, LENGTHS).cache()
    assert result(stream.batch_decisions(df, chunk_rows=chunk_rows)) == loop(df.collect())


@pytest.mark.parametrize("chunk_rows", [800, 200, 100])
def test_rounds_do_not_grow_with_the_chunks(spark, monkeypatch, chunk_rows):
    """A policy that goes on escalating once its rate is high: the window at the start decides all that follows."""
    rows = spark.range(4000).select(
        F.col("id").alias("alert_id"), F.lit(1).cast("long").alias("stream_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.lit(NORMAL).alias("true_label"),
        F.when(F.col("id") == 1900, 2).otherwise(0).alias("choice_0"), F.lit(2).alias("choice_1"), F.lit(2).alias("choice_2"),
        F.lit(0).cast("long").alias("episode_id"),
    ).cache()
    rounds, plain = [], stream._stored
    monkeypatch.setattr(stream, "_stored", lambda df, name: rounds.append(name) or plain(df, name))
    got = result(stream.batch_decisions(rows, chunk_rows=chunk_rows))
    assert got == loop(rows.collect())
    assert rounds.count("walked") <= 3


def test_batch_over_one_global_order(spark):
    df = make(spark, [300, 500, 40]).cache()
    got = result(stream.batch_decisions(df, chunk_rows=100, keys=()))
    assert got == loop(df.collect(), keys=())


def test_batch_with_a_window_longer_than_the_chunks(spark):
    df = make(spark, [400, 5], seed=11).cache()
    assert result(stream.batch_decisions(df, window=150, chunk_rows=20)) == loop(df.collect(), window=150)


def write_batches(df, path, cuts):
    """One file per time slice, with rising modification times."""
    os.makedirs(path)
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = df.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        name = os.path.join(path, f"part{i}.parquet")
        part.toPandas().to_parquet(name, coerce_timestamps="us", index=False)
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture
def streamed(spark, tmp_path):
    def run(df, cuts, **kw):
        source = str(tmp_path / "in")
        write_batches(df, source, cuts)
        session = spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", "4")
        schema = spark.read.parquet(source).schema
        live = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        out = stream.run_to_parquet(stream.stream_decisions(live, **kw), str(tmp_path / "out"), str(tmp_path / "state"))
        return result(spark.read.schema(stream.DECISION_SCHEMA).parquet(out))

    return run


CUTS = ["1970-01-01 00:00:00", "1970-01-01 00:00:40", "1970-01-01 00:02:00", "1970-01-01 00:02:01", "1970-01-02 00:00:00"]


def test_stream_over_several_batches_equals_the_loop(spark, streamed):
    df = make(spark, LENGTHS).cache()
    assert streamed(df, CUTS) == loop(df.collect())


def test_a_new_episode_starts_with_an_empty_window(spark, streamed):
    df = make(spark, [400, 90]).withColumn("episode_id", F.floor(F.second("ts") / 30).cast("long")).cache()
    got = streamed(df, CUTS)
    assert got == loop(df.collect(), episodes=True)
    assert sum(1 for v in got.values() if v[0] == 1) > 2


def test_running_counts_give_the_batch_scorecard(spark, tmp_path, sf_dir):
    from alertloom.plans.catalog import QUERIES

    live = {tuple(r) for r in QUERIES["stream_scorecard"](spark, sf_dir).collect()}
    batch = {tuple(r) for r in QUERIES["policy_comparison"](spark, sf_dir).drop("dataset").collect()}
    assert live == batch


def test_policy_by_bucket_covers_all_pairs(spark):
    q = spark.createDataFrame([(0, 2, 1.0), (1, 1, 1.0)], "state int, action int, q double")
    rows = {(r.predicted_class, r.confidence): (r.choice_0, r.choice_1, r.choice_2) for r in triage.policy_by_bucket(q).collect()}
    assert len(rows) == 20 and rows[0, 0] == (2, 1, 0) and rows[4, 3] == (0, 0, 0)


def test_window_evicts_the_oldest():
    win = stream.DecisionWindow(3)
    for code in "2110":
        win.push(code)
    assert (win.text(), win.escalated, win.false, win.rate()) == ("110", 2, 0, 0.0)
    again = stream.DecisionWindow(3, "2010")
    assert again.text() == "010" and again.escalated == 1


@pytest.fixture
def replayed(spark, tmp_path):
    """Alerts written as time-ordered files, and a stream over them."""

    def make_live(df, files):
        path = sinks.write_time_ordered(df, str(tmp_path / "replay"), ["ts", "alert_id"], files)
        session = spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", "4")
        return session.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)

    return make_live


def batches_of(state):
    return sorted(int(x.name) for x in (state / "commits").iterdir() if x.name.isdigit())


def test_files_are_in_time_order(spark, tmp_path):
    df = make(spark, [500, 20]).cache()
    path = sinks.write_time_ordered(df.repartition(7), str(tmp_path / "ordered"), ["ts", "alert_id"], 5)
    parts = sorted((x for x in (tmp_path / "ordered").iterdir() if x.name.startswith("part-")), key=os.path.getmtime)
    spans = [[(r.ts, r.alert_id) for r in spark.read.parquet(str(x)).collect()] for x in parts]
    assert len(parts) == 5 and all(span == sorted(span) for span in spans)
    assert all(a[-1] < b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(path).count() == 520


def test_one_hot_stream_meets_the_state_in_bounded_parts(spark, tmp_path, replayed, monkeypatch):
    df = make(spark, [4000]).cache()
    counts = tmp_path / "sizes"
    counts.mkdir()
    plain = stream._decided

    def counted(batches, *args):
        rows = list(batches)
        (counts / f"{random.random()}").write_text(str(sum(map(len, rows))))
        return plain(iter(rows), *args)

    monkeypatch.setattr(stream, "_decided", counted)
    out = stream.run_to_parquet(stream.stream_decisions(replayed(df, 8)), str(tmp_path / "out"), str(tmp_path / "state"))
    assert result(spark.read.schema(stream.DECISION_SCHEMA).parquet(out)) == loop(df.collect())
    sizes = [int(x.read_text()) for x in counts.iterdir()]
    assert len(batches_of(tmp_path / "state")) == 8 and sum(sizes) == 4000 and max(sizes) < 1500


def test_a_replayed_batch_adds_no_decision(spark, tmp_path, replayed):
    df = make(spark, [600, 200]).withColumn("predicted_label", F.lit("DoS")).cache()
    live, out, state = replayed(df, 4), str(tmp_path / "out"), tmp_path / "state"
    log = sinks.decision_records(stream.stream_decisions(live))
    read = lambda: sorted(map(tuple, spark.read.schema(log.schema).parquet(out).collect()))
    stream.run_to_parquet(log, out, str(state))
    first = read()
    assert len(first) == 800 and {"predicted_label", "is_fp", "reward", "ts"} <= set(log.columns)
    last = max(batches_of(state))
    for name in (f"{last}", f".{last}.crc"):  # as if the driver was lost before the batch was committed
        (state / "commits" / name).unlink(missing_ok=True)
    stream.run_to_parquet(log, out, str(state))
    assert max(batches_of(state)) == last and read() == first


def test_running_counters_grow_to_the_batch_counts(spark, tmp_path, replayed):
    df = make(spark, [900, 300, 5]).cache()
    history = stream.stream_counters(replayed(df, 5))
    out = stream.run_to_parquet(history, str(tmp_path / "out"), str(tmp_path / "state"))
    rows = spark.read.schema(stream.COUNTS_SCHEMA).parquet(out)
    steps = {}
    for r in rows.collect():
        steps.setdefault((r.stream_id, r.true_label, r.action), []).append((r.step, r.n))
    assert max(len(v) for v in steps.values()) > 1
    for held in steps.values():
        numbers = [n for _, n in sorted(held)]
        assert numbers == sorted(numbers)
    got = {(r.true_label, r.action): r.n for r in stream.latest_counts(rows).collect()}
    labels = {r.alert_id: r.true_label for r in df.collect()}
    want = {}
    for alert, (*_, action) in loop(df.collect()).items():
        want[labels[alert], action] = want.get((labels[alert], action), 0) + 1
    assert got == want


@pytest.mark.parametrize("rows", [0, 1_000, 600_000, 6_000_000, 36_000_000])
def test_micro_batches_hold_up_to_a_million_rows(rows):
    from alertloom.plans.catalog import LEAST_TRIGGERS, replay_plan

    files, at_once = replay_plan(rows)
    triggers = -(-files // at_once)
    assert LEAST_TRIGGERS <= triggers <= max(2 * LEAST_TRIGGERS, -(-rows // 1_000_000) + 1)
    assert rows / files * at_once <= 1_000_000


def test_state_has_no_more_partitions_than_cores(spark):
    from alertloom.plans.catalog import _stream_session

    wide = spark.newSession()
    wide.conf.set("spark.sql.shuffle.partitions", "600")
    assert _stream_session(wide).conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    wide.conf.set("spark.sql.shuffle.partitions", "3")
    assert _stream_session(wide).conf.get("spark.sql.shuffle.partitions") == "3"


def test_several_files_of_a_micro_batch_equal_the_loop(spark, tmp_path):
    df = make(spark, LENGTHS).cache()
    path = sinks.write_time_ordered(df, str(tmp_path / "replay"), ["ts", "alert_id"], 12)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    live = session.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 5).parquet(path)
    out = stream.run_to_parquet(stream.stream_decisions(live), str(tmp_path / "out"), str(tmp_path / "state"))
    assert len(batches_of(tmp_path / "state")) == 3
    assert result(spark.read.schema(stream.DECISION_SCHEMA).parquet(out)) == loop(df.collect())
