"""Triage learning from aggregated transitions.

A decision only moves the false-positive bucket of its own (class, confidence)
pair, so the 60 states are 20 separate chains of 3. Two grouped counts hold all
a tabular learner needs; every sweep after that works on one small row per chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.functions.expressions import (
    decode_state,
    encode_state,
    epsilon_after,
    epsilon_greedy,
    first_argmax,
    is_attack,
    random_action,
    reward,
    triage_state,
)
from alertloom.operators.ordered import rolling_fp_rate, rolling_fp_rates
from alertloom.params import DEFAULTS, ESCALATE, N_ACTIONS, N_FP, N_STATES, Costs

PAIRS = N_FP * N_ACTIONS


def transitions(
    df: DataFrame,
    keys: Sequence[str] = ("stream_id",),
    order: Sequence[str] = ("ts", "alert_id"),
    key: str = "alert_id",
    epoch: int = 0,
    window: int = DEFAULTS.window,
    costs: Costs = DEFAULTS.costs,
    **kw,
) -> DataFrame:
    """Decisions of a fully random behavior policy: state, action, reward and next state.

    The action does not depend on the state, so all decisions are drawn in one
    projection and the false-positive context is an ordinary window over them.
    """
    needed = df.select(*{key, *keys, *order, "true_label", "predicted_class", "predicted_proba"})
    acted = needed.withColumn("action", random_action(key, str(epoch)))
    rated = rolling_fp_rate(acted, keys, order, window=window, **kw)
    return (
        rated.withColumn("state", triage_state("predicted_class", "predicted_proba", F.col("fp_rate_before")))
        .withColumn("next_state", triage_state("predicted_class", "predicted_proba", F.col("fp_rate_after")))
        .withColumn("reward", reward("action", "true_label", costs))
        .select(key, *keys, "state", "action", "reward", "next_state")
    )


def mdp_estimate(trans: DataFrame) -> DataFrame:
    """Per (state, action, next_state): count, probability, and mean reward of (state, action)."""
    counts = trans.groupBy("state", "action", "next_state").agg(
        F.count("*").alias("n"), F.sum("reward").alias("reward_sum")
    )
    pair = Window.partitionBy("state", "action")  # at most 3 rows each
    return counts.select(
        "state",
        "action",
        "next_state",
        "n",
        (F.col("n") / F.sum("n").over(pair)).alias("p"),
        (F.sum("reward_sum").over(pair) / F.sum("n").over(pair)).alias("mean_reward"),
    )


def _chains(mdp: DataFrame) -> DataFrame:
    """One row per (class, confidence).

    ``r`` holds the mean reward by fp * 3 + action, null where the pair was never
    seen, and ``p`` the probability by (fp * 3 + action) * 3 + next fp.
    """
    klass, conf, fp = decode_state("state")
    _, _, fp_next = decode_state("next_state")
    pair = fp * N_ACTIONS + F.col("action")
    cells = mdp.select(
        klass.alias("klass"), conf.alias("conf"), pair.alias("pair"), fp_next.alias("fp_next"), "p", "mean_reward"
    )
    # at most 27 entries per chain
    maps = cells.groupBy("klass", "conf").agg(
        F.map_from_entries(F.collect_set(F.struct("pair", "mean_reward"))).alias("rewards"),
        F.map_from_entries(F.collect_list(F.struct(F.col("pair") * N_FP + F.col("fp_next"), "p"))).alias("moves"),
    )
    return maps.select(
        "klass",
        "conf",
        F.expr(f"transform(sequence(0, {PAIRS - 1}), i -> try_element_at(rewards, i))").alias("r"),
        F.expr(f"transform(sequence(0, {PAIRS * N_FP - 1}), i -> coalesce(try_element_at(moves, i), 0D))").alias("p"),
    )


def fold_values(sweeps: int | str, gamma: float, step: float | None = None) -> Column:
    """Action values of a chain (columns ``r`` and ``p``) after a number of sweeps, from all zeros.

    All values are updated at once from those of the sweep before; pairs never
    seen keep theirs. With ``step`` a value moves that part of the way to its
    target. The sweeps are a fold over a sequence inside one expression: no job,
    shuffle or driver round trip per sweep. ``sweeps`` may name a column.
    """
    future = " + ".join(
        f"p[i * {N_FP} + {b}] * array_max(slice(q, {b * N_ACTIONS + 1}, {N_ACTIONS}))" for b in range(N_FP)
    )
    target = f"(r[i] + {gamma}D * ({future}))"
    moved = target if step is None else f"q[i] + {step}D * ({target} - q[i])"
    return F.expr(
        f"aggregate(sequence(1, {sweeps}), array_repeat(0D, {PAIRS}), "
        f"(q, k) -> transform(sequence(0, {PAIRS - 1}), i -> coalesce({moved}, q[i])))"
    )


def _as_table(chains: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(klass, conf, q) -> (state, action, q)."""
    rows = chains.select(*extra, "klass", "conf", F.posexplode("q").alias("pair", "q"))
    fp = F.floor(F.col("pair") / N_ACTIONS)
    return rows.select(
        *extra,
        encode_state("klass", "conf", fp).alias("state"),
        (F.col("pair") % N_ACTIONS).cast("int").alias("action"),
        "q",
    )


def full_table(q_table: DataFrame) -> DataFrame:
    """All 60 x 3 pairs; those of unseen states are zero."""
    spark = q_table.sparkSession
    frame = spark.range(N_STATES * N_ACTIONS).select(
        F.floor(F.col("id") / N_ACTIONS).cast("int").alias("state"), (F.col("id") % N_ACTIONS).cast("int").alias("action")
    )
    return frame.join(F.broadcast(q_table), ["state", "action"], "left").fillna(0.0, ["q"])


def q_iteration(mdp: DataFrame, sweeps: int = 50, gamma: float = DEFAULTS.gamma) -> DataFrame:
    """Q <- E[r] + gamma * E[max Q(next)], a fixed number of sweeps from zero."""
    chains = _chains(mdp)
    return full_table(_as_table(chains.withColumn("q", fold_values(sweeps, gamma))))


def batch_td_epochs(
    mdp: DataFrame, epochs: int = 15, alpha: float = DEFAULTS.alpha, gamma: float = DEFAULTS.gamma
) -> DataFrame:
    """Values after each epoch when every epoch moves Q by ``alpha`` times the mean TD error of the pair.

    Q is frozen within an epoch, so the mean error follows from the estimate.
    """
    chains = _chains(mdp).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    return _as_table(chains.withColumn("q", fold_values("epoch", gamma, alpha)), ["epoch"])


def epsilon_schedule(epochs: DataFrame, epoch: str = "epoch") -> DataFrame:
    """Adds ``epsilon``, the exploration rate after each epoch."""
    return epochs.withColumn("epsilon", epsilon_after(epoch))


def epoch_history(
    df: DataFrame,
    values: DataFrame,
    epochs: int = 15,
    key: str = "alert_id",
    keys: Sequence[str] = ("stream_id",),
    order: Sequence[str] = ("ts", "alert_id"),
    costs: Costs = DEFAULTS.costs,
    recall_floor: float = DEFAULTS.recall_floor,
    **kw,
) -> DataFrame:
    """Cost, system recall and exploration rate per epoch of exploring around the values being learned.

    ``values`` are those after each epoch (``batch_td_epochs``). Epoch k acts on the values left by
    the k-1 epochs before it (zeros at first) in the false-positive context of its own behavior
    decisions (the rows are shuffled once for all epochs), and explores at the rate left by k-1 decays; the reported rate is the one after its own.
    """
    needed = df.select(*{key, *keys, *order, "true_label", "predicted_class", "predicted_proba"})
    behavior = random_action(key, F.col("run").cast("string"))
    rated = rolling_fp_rates(needed, epochs, behavior, keys, order, **kw).withColumnRenamed("run", "epoch")
    rated = rated.withColumn("state", triage_state("predicted_class", "predicted_proba", F.col("fp_rate_before")))
    # at most 60 states for each epoch
    cells = [F.coalesce(F.max(F.when(F.col("action") == a, F.col("q"))), F.lit(0.0)) for a in range(N_ACTIONS)]
    known = values.groupBy((F.col("epoch") + 1).alias("epoch"), "state").agg(first_argmax(F.array(*cells)).alias("_best"))
    acted = rated.drop("action").join(F.broadcast(known), ["epoch", "state"], "left")
    acted = acted.withColumn("_best", F.coalesce("_best", F.lit(0)))
    acted = acted.withColumn(
        "action", epsilon_greedy(key, "_best", epsilon_after(F.col("epoch") - 1), F.col("epoch").cast("string"))
    )
    counts = acted.groupBy("epoch", "true_label", "action").agg(F.count("*").alias("n"))
    n, attack, hit = F.col("n"), is_attack("true_label"), F.col("action") == ESCALATE
    sums = counts.groupBy("epoch").agg(
        F.sum(-reward("action", "true_label", costs) * n).alias("cot"),
        F.coalesce(F.sum(F.when(attack & hit, n)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(attack, n)), F.lit(0)).alias("attacks"),
    )
    recall = F.when(F.col("attacks") > 0, F.col("tp") / F.col("attacks")).otherwise(1.0)
    return sums.select(
        "epoch",
        "cot",
        recall.alias("recall"),
        (recall >= recall_floor).alias("recall_ok"),
        epsilon_after("epoch").alias("epsilon"),
    )


def learn_policy(alerts: DataFrame, sweeps: int = 50, **kw) -> DataFrame:
    """Action values learned from alerts with known classes."""
    return q_iteration(mdp_estimate(transitions(alerts, **kw)), sweeps)
