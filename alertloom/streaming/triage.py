"""Triage whose actions feed back into their own context, in streams and in batch.

The action depends on the false-positive rate of the last decisions, and the
decision then enters that window: within a stream the steps are sequential. Both
forms below share one step function over the actions precomputed per
false-positive bucket, so Python only walks small integers.
"""

from __future__ import annotations

import json
import sys
from collections import Counter, deque
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from alertloom.operators.ordered import CHUNK_ROWS, positioned
from alertloom.params import DEFAULTS, ESCALATE, FP_RATE_CUTS, N_FP, NORMAL
from alertloom.session import scratch_path

# Executors need not have this package: its functions are sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHOICES = [f"choice_{b}" for b in range(N_FP)]
DECISION_SCHEMA = (
    "alert_id bigint, stream_id bigint, true_label string, kept int, fp_rate_before double, fp_rate_after double, action int"
)
STREAM_SCHEMA = f"{DECISION_SCHEMA}, predicted_label string, ts timestamp_ntz"
COUNTS_SCHEMA = "stream_id bigint, step bigint, true_label string, action int, n bigint"
STATE_SCHEMA = "episode bigint, codes string"
COUNTING_SCHEMA = f"{STATE_SCHEMA}, step bigint, counts string"

# One character per kept decision.
QUIET, ESCALATED_ATTACK, ESCALATED_NORMAL = "0", "1", "2"


class DecisionWindow:
    """The last ``size`` decisions with running counts."""

    def __init__(self, size: int, codes: str = ""):
        codes = codes[-size:]
        self.codes = deque(codes, maxlen=size)
        self.escalated = len(codes) - codes.count(QUIET)
        self.false = codes.count(ESCALATED_NORMAL)

    def rate(self) -> float:
        return self.false / self.escalated if self.escalated else 0.0

    def push(self, code: str) -> None:
        if len(self.codes) == self.codes.maxlen:
            oldest = self.codes[0]
            self.escalated -= oldest != QUIET
            self.false -= oldest == ESCALATED_NORMAL
        self.codes.append(code)
        self.escalated += code != QUIET
        self.false += code == ESCALATED_NORMAL

    def text(self) -> str:
        return "".join(self.codes)


def _walk(window: DecisionWindow, choices: Sequence[Sequence[int]], normal: Sequence[bool]):
    """Decide in order; returns kept counts, rates before and after, and actions."""
    low, high = FP_RATE_CUTS
    kept, before, after, actions = [], [], [], []
    rate = window.rate()
    for i, is_normal in enumerate(normal):
        before.append(rate)
        action = choices[0 if rate < low else 1 if rate < high else 2][i]
        window.push((ESCALATED_NORMAL if is_normal else ESCALATED_ATTACK) if action == ESCALATE else QUIET)
        rate = window.rate()
        kept.append(len(window.codes))
        after.append(rate)
        actions.append(action)
    return kept, before, after, actions


def _decide(rows: pd.DataFrame, window: DecisionWindow) -> pd.DataFrame:
    kept, before, after, actions = _walk(
        window, [rows[c].tolist() for c in CHOICES], (rows["true_label"] == NORMAL).tolist()
    )
    return pd.DataFrame(
        {
            "alert_id": rows["alert_id"].to_numpy(),
            "stream_id": rows["stream_id"].to_numpy(),
            "true_label": rows["true_label"].to_numpy(),
            "kept": pd.array(kept, dtype="int32"),
            "fp_rate_before": before,
            "fp_rate_after": after,
            "action": pd.array(actions, dtype="int32"),
        }
    )


def fixed_choices(df: DataFrame, action: str = "action") -> DataFrame:
    """Choices of a policy that does not look at the false-positive rate."""
    return df.withColumns({c: F.col(action) for c in CHOICES})


# --- streaming ---------------------------------------------------------------------------


def _needed(df: DataFrame) -> DataFrame:
    if "episode_id" not in df.columns:
        df = df.withColumn("episode_id", F.lit(0).cast("bigint"))
    if "predicted_label" not in df.columns:
        df = df.withColumn("predicted_label", F.lit(None).cast("string"))
    return df.select("alert_id", "stream_id", "ts", "episode_id", "true_label", "predicted_label", *CHOICES)


def _decided(batches: Iterator[pd.DataFrame], window: int, episode: int | None, codes: str):
    """(decisions, episode, codes) of each run of one episode; the last ones are the new state."""
    rows = pd.concat(list(batches)).sort_values(["ts", "alert_id"], kind="stable")
    runs = (rows["episode_id"] != rows["episode_id"].shift()).cumsum()
    for _, run in rows.groupby(runs, sort=False):
        current = int(run["episode_id"].iloc[0])
        win = DecisionWindow(window, codes if current == episode else "")
        found = _decide(run, win)
        episode, codes = current, win.text()
        yield found.assign(predicted_label=run["predicted_label"].to_numpy(), ts=run["ts"].to_numpy()), episode, codes


def stream_decisions(df: DataFrame, window: int = DEFAULTS.window) -> DataFrame:
    """Decisions of a streaming input of alerts with choices, in append mode.

    The state of a stream is its episode and the last ``window`` decisions; a new
    ``episode_id`` starts with an empty window. Rows of a micro-batch are ordered
    by (ts, alert_id); across micro-batches by arrival, so files should arrive in
    time order (``sinks.write_time_ordered``). One stream's rows of a micro-batch
    are held in memory: the trigger of the source bounds them, also for a hot stream.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        episode, codes = state.get if state.exists else (None, "")
        for found, episode, codes in _decided(batches, window, episode, codes):
            yield found
        state.update((episode, codes))

    return _needed(df).groupBy("stream_id").applyInPandasWithState(
        step, STREAM_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def stream_counters(df: DataFrame, window: int = DEFAULTS.window) -> DataFrame:
    """Running counts of the fed-back decisions: after every micro-batch those of each stream it touched.

    Each ``step`` of a stream gives all its (true_label, action) counts so far, so
    its last step is its state and earlier ones are its history.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        episode, codes, at, text = state.get if state.exists else (None, "", 0, "[]")
        counts = Counter({(label, action): n for label, action, n in json.loads(text)})
        for found, episode, codes in _decided(batches, window, episode, codes):
            counts.update(zip(found["true_label"].tolist(), found["action"].tolist()))
        held = sorted((label, int(action), n) for (label, action), n in counts.items())
        state.update((episode, codes, at + 1, json.dumps(held)))
        yield pd.DataFrame(held, columns=["true_label", "action", "n"]).assign(stream_id=key[0], step=at + 1)[
            ["stream_id", "step", "true_label", "action", "n"]
        ].astype({"action": "int32"})

    return _needed(df).groupBy("stream_id").applyInPandasWithState(
        step, COUNTS_SCHEMA, COUNTING_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def latest_counts(history: DataFrame) -> DataFrame:
    """``true_label, action, n`` over all streams at their last step."""
    last = history.groupBy("stream_id").agg(F.max("step").alias("step"))
    return history.join(last, ["stream_id", "step"]).groupBy("true_label", "action").agg(F.sum("n").alias("n"))


def stream_policy_counts(df: DataFrame, policies: Mapping[str, Column]) -> DataFrame:
    """Running (policy, true_label, action, n) of a stream: a few dozen rows whatever its length."""
    # a single aggregation, because chained ones cannot run in complete mode
    names = list(policies)
    pairs = F.array(*[F.struct(F.lit(p).alias("policy"), policies[p].cast("int").alias("action")) for p in names])
    return (
        df.select("true_label", F.inline(pairs)).groupBy("policy", "true_label", "action").agg(F.count("*").alias("n"))
    )


def run_to_parquet(df: DataFrame, path: str, checkpoint: str) -> str:
    """Process everything available and append it to Parquet."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path


def run_to_memory(df: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Process everything available and keep the complete result. For results of bounded size only."""
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.table(name)


# --- batch -----------------------------------------------------------------------------------

#: Windows from which a chunk is walked before its own is known: empty, and one for each higher bucket.
SUPPOSED = ("", *[(ESCALATED_NORMAL * 2 + ESCALATED_ATTACK * 8), ESCALATED_NORMAL])
WALKED_SCHEMA = "_key string, _chunk bigint, start string, end string"


def batch_decisions(
    df: DataFrame,
    window: int = DEFAULTS.window,
    chunk_rows: int = CHUNK_ROWS,
    keys: Sequence[str] = ("stream_id",),
) -> DataFrame:
    """The same decisions for a bounded table, parallel within a stream as well.

    A stream is cut into chunks of equal length by position, and a chunk must be
    walked from the window the chunk before ends with. Which one that is depends
    on all before, but only few windows are possible: every chunk is first walked
    from one supposed window per false-positive bucket, next from all windows the
    chunk before was seen to end with, until no new ones turn up. Walks that come
    to the same window go on as one, so they cost little more than one walk, and
    as a window forgets after ``window`` decisions they nearly always do: then
    the second round finds nothing new and all chunks are done, whatever their
    number. Only walks that never meet, chunk after chunk, make more rounds (at
    worst one per chunk). The ends of each chunk then form a table from start to
    end, which is followed along each stream: one row per chunk and window.
    """
    needed = dict.fromkeys(["alert_id", "stream_id", "ts", "true_label", *keys, *CHOICES])
    rows = positioned(df.select(*needed), keys, ["ts", "alert_id"])
    size = max(chunk_rows, window)
    rows = rows.withColumn("_key", F.to_json("_key")).withColumn("_chunk", F.floor(F.col("_pos") / size))
    rows = _stored(rows.select("_key", "_chunk", "_pos", "alert_id", "stream_id", "true_label", *CHOICES), "chunks")
    chunks = _stored(rows.select("_key", "_chunk").distinct(), "chunk-names")

    repeated = [(c * window)[:window] for c in SUPPOSED]
    first = F.when(F.col("_chunk") == 0, F.array(F.lit(""))).otherwise(F.array(*map(F.lit, repeated)))
    starts = chunks.withColumn("starts", first)
    walked = None
    while True:
        found = _marked(rows, starts, size).mapInPandas(_walker(window), WALKED_SCHEMA)
        walked = _stored(found if walked is None else walked.unionByName(found), "walked")
        ends = walked.select("_key", (F.col("_chunk") + 1).alias("_chunk"), F.col("end").alias("start")).distinct()
        new = ends.join(chunks, ["_key", "_chunk"]).join(walked, ["_key", "_chunk", "start"], "left_anti")
        starts = _stored(new.groupBy("_key", "_chunk").agg(F.collect_set("start").alias("starts")), "starts")
        if starts.isEmpty():
            break

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        ends = {(c, s): e for c, s, e in zip(frame["_chunk"], frame["start"], frame["end"], strict=True)}
        out, at = [], ""
        for chunk in sorted(set(frame["_chunk"])):
            out.append((frame["_key"].iloc[0], chunk, [at]))
            at = ends[chunk, at]
        return pd.DataFrame(out, columns=["_key", "_chunk", "starts"])

    known = walked.groupBy("_key").applyInPandas(follow, "_key string, _chunk bigint, starts array<string>")
    return _marked(rows, known, size).mapInPandas(_decision_walker(window), DECISION_SCHEMA)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _marked(rows: DataFrame, starts: DataFrame, size: int) -> DataFrame:
    """Chunks that have starts, in order, each led by a row that holds its starts."""
    wanted = rows.join(starts.select("_key", "_chunk"), ["_key", "_chunk"], "left_semi")
    # no nulls in whole numbers, which pandas would turn into floats
    blank = {c: F.lit(0).cast(rows.schema[c].dataType) for c in ("alert_id", "stream_id", *CHOICES)}
    leads = starts.withColumns({"_pos": F.col("_chunk") * size - 1, **blank})
    both = wanted.unionByName(leads, allowMissingColumns=True)
    return both.repartition("_key", "_chunk").sortWithinPartitions("_key", "_chunk", "_pos")


def _runs(batches: Iterator[pd.DataFrame]):
    """(starts, None) at the head of a chunk, then (None, rows) for its parts."""
    for batch in batches:
        heads = batch["starts"].notna().to_numpy()
        edges = sorted({0, len(batch), *[i + d for i in heads.nonzero()[0].tolist() for d in (0, 1)]})
        for a, b in zip(edges, edges[1:]):
            part = batch.iloc[a:b]
            yield (part.iloc[0], None) if heads[a] else (None, part)


def _walker(size: int):
    """Ends of every chunk for its starts. Walks are compared every ``size`` rows and go on as one when equal."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, live = None, []

        def ended() -> pd.DataFrame:
            rows = [(head["_key"], head["_chunk"], start, win.text()) for names, win in live for start in names]
            return pd.DataFrame(rows, columns=["_key", "_chunk", "start", "end"])

        for lead, rows in _runs(batches):
            if lead is not None:
                if head is not None:
                    yield ended()
                head, live = lead, [([s], DecisionWindow(size, s)) for s in lead["starts"]]
                continue
            choices = [rows[c].tolist() for c in CHOICES]
            normal = (rows["true_label"] == NORMAL).tolist()
            for i in range(0, len(normal), size):
                part = [c[i : i + size] for c in choices]
                for _, win in live:
                    _walk(win, part, normal[i : i + size])
                if len(live) > 1:
                    met: dict[str, tuple[list[str], DecisionWindow]] = {}
                    for names, win in live:
                        met.setdefault(win.text(), ([], win))[0].extend(names)
                    live = list(met.values())
        if head is not None:
            yield ended()

    return walk


def _decision_walker(size: int):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        win = None
        for lead, rows in _runs(batches):
            if lead is not None:
                win = DecisionWindow(size, lead["starts"][0])
            else:
                yield _decide(rows, win)

    return walk
