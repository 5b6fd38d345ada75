"""Alert triage: predictions, states, policies and their cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from alertloom.functions.expressions import (
    action_name,
    confidence_bucket,
    decode_state,
    first_argmax,
    is_attack,
    label_name,
    policy_argmax,
    policy_escalate_all,
    policy_heuristic,
    policy_threshold,
    reward,
    triage_state,
)
from alertloom.params import (
    ACTION_NAMES,
    DEFAULTS,
    DOS,
    ESCALATE,
    IGNORE,
    LABELS,
    MONITOR,
    N_ACTIONS,
    N_FP,
    N_STATES,
    SCORECARD_COLUMNS,
    Costs,
)

# --- predictions ---------------------------------------------------------------


def alerts_from_predictions(predictions: DataFrame, key: str, events: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Predictions as a source of alerts: class indices of ``labels``, and ``stream_id, ts`` of their ``events``."""
    index = lambda name: (F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(name)) - 1).cast("int")
    return predictions.join(events, F.col(key) == F.col("alert_id")).select(
        "alert_id",
        "stream_id",
        "ts",
        index("true_label").alias("true_class"),
        "true_label",
        index("predicted_label").alias("predicted_class"),
        "predicted_label",
        "predicted_proba",
        "split",
    )


def extract_predictions(
    df: DataFrame,
    probability: str = "probability",
    prediction: str = "prediction",
    label: str = "attack_category",
    labels: Sequence[str] = LABELS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Model output -> true label, predicted class, its name and the highest probability."""
    proba = F.col(probability)
    if not isinstance(df.schema[probability].dataType, ArrayType):
        proba = vector_to_array(proba)
    return df.select(
        *keep,
        F.col(label).alias("true_label"),
        F.col(prediction).cast("int").alias("predicted_class"),
        F.array_max(proba).alias("predicted_proba"),
        label_name(prediction, labels).alias("predicted_label"),
    )


# --- policies --------------------------------------------------------------------


def baseline_policies(threshold: float = DEFAULTS.threshold) -> dict[str, Column]:
    """Stateless policies as action columns over an alert."""
    return {
        "escalate_all": policy_escalate_all(),
        "threshold": policy_threshold("predicted_class", "predicted_proba", threshold),
        "argmax": policy_argmax("predicted_class"),
        "heuristic": policy_heuristic("predicted_class", "predicted_proba"),
    }


def with_action(df: DataFrame, action: Column) -> DataFrame:
    return df.withColumn("action", action.cast("int"))


def counterfactual_rewards(df: DataFrame, costs: Costs = DEFAULTS.costs) -> DataFrame:
    """Every alert with the reward of each of the actions."""
    return df.withColumn("action", F.explode(F.array(*[F.lit(a) for a in range(N_ACTIONS)]))).withColumn(
        "reward", reward("action", "true_label", costs)
    )


# --- cost table --------------------------------------------------------------------


def cost_table(spark, costs: Costs = DEFAULTS.costs) -> DataFrame:
    """The five priced situations."""
    return spark.createDataFrame(
        [
            ("fn_attack", float(costs.fn_attack)),
            ("fn_dos", float(costs.fn_dos)),
            ("fp_normal", float(costs.fp_normal)),
            ("escalation", float(costs.escalation)),
            ("tn_saving", float(costs.tn_saving)),
        ],
        "situation string, cost double",
    )


def situations(df: DataFrame, costs: Costs = DEFAULTS.costs) -> DataFrame:
    """How often each priced situation occurs in a set of decisions, and what it costs.

    A monitored attack is a third of ``fn_attack``; an escalated normal pays both
    ``escalation`` and ``fp_normal``.
    """
    attack, a = is_attack("true_label"), F.col("action")
    missed = (
        F.when((a == IGNORE) & attack & (F.col("true_label") != DOS), 1.0)
        .when((a == MONITOR) & attack, 1.0 / 3.0)
        .otherwise(0.0)
    )
    units = {
        "fn_attack": missed,
        "fn_dos": F.when((a == IGNORE) & (F.col("true_label") == DOS), 1.0).otherwise(0.0),
        "fp_normal": F.when((a == ESCALATE) & ~attack, 1.0).otherwise(0.0),
        "escalation": F.when(a == ESCALATE, 1.0).otherwise(0.0),
        "tn_saving": F.when((a == IGNORE) & ~attack, 1.0).otherwise(0.0),
    }
    shares = F.array(*[F.struct(F.lit(s).alias("situation"), u.alias("share")) for s, u in units.items()])
    # counted per (action, class) first, so only those few rows are spread over the situations
    counts = df.groupBy("action", "true_label").agg(F.count("*").alias("n"))
    spread = counts.select("n", F.inline(shares))
    used = spread.groupBy("situation").agg(
        F.sum(F.when(F.col("share") > 0, F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.col("n") * F.col("share")).alias("units"),
    )
    return used.join(F.broadcast(cost_table(df.sparkSession, costs)), "situation").select(
        "situation", "cost", "n", (F.col("units") * F.col("cost")).alias("total_cost")
    )


# --- scorecard -----------------------------------------------------------------------


def policy_counts(df: DataFrame, policies: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(policy, true_label, action, n) for all policies in one pass.

    Rows are counted once per combination of class and actions, a few dozen at
    most, and only those counts are spread over the policies.
    """
    names = list(policies)
    acted = df.select(*by, "true_label", *[policies[p].cast("int").alias(p) for p in names])
    counts = acted.groupBy(*by, "true_label", *names).agg(F.count("*").alias("n"))
    spread = F.array(*[F.struct(F.lit(p).alias("policy"), F.col(p).alias("action")) for p in names])
    return (
        counts.select(*by, "true_label", "n", F.inline(spread))
        .groupBy(*by, "policy", "true_label", "action")
        .agg(F.sum("n").alias("n"))
    )


def action_counts(df: DataFrame, policy: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts in the same form for decisions already taken (column ``action``)."""
    return df.groupBy(*by, F.lit(policy).alias("policy"), "true_label", "action").agg(F.count("*").alias("n"))


def scorecard(
    counts: DataFrame,
    by: Sequence[str] = ("policy",),
    costs: Costs = DEFAULTS.costs,
    recall_floor: float = DEFAULTS.recall_floor,
) -> DataFrame:
    """Cost, system recall, precision, F1 and action mix per policy.

    Recall is 1.0 without attacks, precision 1.0 without escalations, F1 0.0 when
    both are zero.
    """
    n, attack, escalated = F.col("n"), is_attack("true_label"), F.col("action") == ESCALATE
    total = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    sums = counts.groupBy(*by).agg(
        F.sum(n).alias("alerts"),
        F.sum(-reward("action", "true_label", costs) * n).alias("cot"),
        total(escalated & attack).alias("tp"),
        total(escalated & ~attack).alias("fp"),
        total(~escalated & attack).alias("fn"),
        *[total(F.col("action") == a).alias(f"n_{a}") for a in range(N_ACTIONS)],
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = sums.withColumn("recall", F.when(tp + fn > 0, tp / (tp + fn)).otherwise(1.0)).withColumn(
        "precision", F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    )
    r, p = F.col("recall"), F.col("precision")
    f1 = F.when(r + p > 0, 2 * r * p / (r + p)).otherwise(0.0)
    named = SCORECARD_COLUMNS
    return rates.select(
        *by,
        F.round("cot", 2).alias(named["cost"]),
        F.round(F.col("cot") / F.col("alerts"), 4).alias(named["cost_per_alert"]),
        F.round(r, 4).alias(named["recall"]),
        F.round(p, 4).alias(named["precision"]),
        F.round(f1, 4).alias(named["f1"]),
        *[F.round(F.col(f"n_{a}") / F.col("alerts"), 4).alias(named["share_prefix"] + name) for a, name in enumerate(ACTION_NAMES)],
        (r >= recall_floor).alias(named["recall_ok"]),
    )


def policy_comparison(df: DataFrame, policies: Mapping[str, Column], dataset: str | None = None, **kw) -> DataFrame:
    """Scorecard of all policies over the same alerts, cheapest first."""
    report = scorecard(policy_counts(df, policies), **kw)
    if dataset is not None:
        report = report.withColumn("dataset", F.lit(dataset))
    return report.orderBy("COT", "policy")


def savings_vs_baseline(report: DataFrame, baseline: str = "escalate_all") -> DataFrame:
    """Cost saved by each policy against the baseline policy, absolute and in percent."""
    base = F.max(F.when(F.col("policy") == baseline, F.col("COT"))).over(Window.partitionBy())
    return report.select("policy", "COT", base.alias("baseline_COT")).select(
        "policy",
        "COT",
        (F.col("baseline_COT") - F.col("COT")).alias("savings"),
        F.round(F.try_divide((F.col("baseline_COT") - F.col("COT")) * 100, F.col("baseline_COT")), 2).alias("savings_pct"),
    )


def policy_overfit(report: DataFrame, split: str = "split") -> DataFrame:
    """Cost per alert and recall of each policy on validation and test, and what they gain or lose on test."""
    named = {"cost": SCORECARD_COLUMNS["cost_per_alert"], "recall": SCORECARD_COLUMNS["recall"]}
    sides = [
        F.max(F.when(F.col(split) == s, F.col(c))).alias(f"{n}_{s}") for n, c in named.items() for s in ("val", "test")
    ]
    both = report.groupBy("policy").agg(*sides)
    return both.select(
        "*",
        F.round(F.col("cost_test") - F.col("cost_val"), 4).alias("cost_delta"),
        F.round(F.col("recall_test") - F.col("recall_val"), 4).alias("recall_delta"),
    )


def best_valid_policy(report: DataFrame) -> DataFrame:
    """Cheapest policy that keeps the recall floor; no row if there is none."""
    return report.filter("recall_OK").orderBy("COT", "policy").limit(1)


# --- learned policy ---------------------------------------------------------------------


def q_by_state(q_table: DataFrame) -> DataFrame:
    """(state, action, q) -> one array of action values per state (at most 60 rows)."""
    cells = [F.coalesce(F.max(F.when(F.col("action") == a, F.col("q"))), F.lit(0.0)) for a in range(N_ACTIONS)]
    return (
        q_table.filter(F.col("state").between(0, N_STATES - 1))
        .groupBy("state")
        .agg(F.array(*cells).alias("q_values"))
    )


def with_greedy_action(df: DataFrame, q_table: DataFrame, state: str = "state", name: str = "action") -> DataFrame:
    """Best known action of the state, first one on ties; ignore for an unseen state."""
    # keys are confined to the 60 states, which bounds the broadcast
    lookup = F.broadcast(q_by_state(q_table).withColumnRenamed("state", "_state"))
    joined = df.join(lookup, F.col(state) == F.col("_state"), "left").drop("_state")
    values = F.coalesce("q_values", F.array(*[F.lit(0.0)] * N_ACTIONS))
    return joined.withColumn("q_values", values).withColumn(name, first_argmax("q_values"))


def policy_by_bucket(q_table: DataFrame) -> DataFrame:
    """Greedy action for each false-positive bucket, per (class, confidence): 20 rows."""
    states = q_table.sparkSession.range(N_STATES).select(F.col("id").cast("int").alias("state"))
    klass, conf, fp = decode_state("state")
    chosen = with_greedy_action(states, q_table).select(
        klass.alias("predicted_class"), conf.alias("confidence"), fp.alias("fp"), "action"
    )
    return chosen.groupBy("predicted_class", "confidence").agg(
        *[F.max(F.when(F.col("fp") == b, F.col("action"))).alias(f"choice_{b}") for b in range(N_FP)]
    )


def with_choices(df: DataFrame, q_table: DataFrame) -> DataFrame:
    """Adds the action the learned policy would take in each false-positive bucket."""
    lookup = F.broadcast(policy_by_bucket(q_table).withColumnRenamed("predicted_class", "_class"))
    on = (F.col("predicted_class") == F.col("_class")) & (confidence_bucket("predicted_proba") == F.col("confidence"))
    return df.join(lookup, on, "left").drop("_class", "confidence").fillna(
        IGNORE, [f"choice_{b}" for b in range(N_FP)]
    )


def policy_grid(q_table: DataFrame) -> DataFrame:
    """Best action per (class, confidence) with the values averaged over the false-positive buckets."""
    states = q_table.sparkSession.range(N_STATES).select(F.col("id").cast("int").alias("state"))
    klass, conf, _ = decode_state("state")
    full = with_greedy_action(states, q_table).select(klass.alias("predicted_class"), conf.alias("confidence"), "q_values")
    means = full.groupBy("predicted_class", "confidence").agg(
        F.array(*[F.avg(F.col("q_values")[a]) for a in range(N_ACTIONS)]).alias("q")
    )
    best = first_argmax("q")
    return means.select(
        label_name("predicted_class").alias("predicted_label"), "confidence", best.alias("action"),
        action_name(best).alias("action_name"),
    )


def action_mix_by_class(df: DataFrame, q_table: DataFrame) -> DataFrame:
    """Share of each greedy action per predicted class, with the false-positive rate at zero."""
    state = triage_state("predicted_class", "predicted_proba", F.lit(0.0))
    per_state = df.groupBy("predicted_label", state.alias("state")).agg(F.count("*").alias("n"))
    acted = with_greedy_action(per_state, q_table)
    total = F.sum("n")
    return acted.groupBy("predicted_label").agg(
        total.alias("n"),
        *[
            F.round(F.coalesce(F.sum(F.when(F.col("action") == a, F.col("n"))), F.lit(0)) / total, 4).alias(f"pct_{name}")
            for a, name in enumerate(ACTION_NAMES)
        ],
    )


def simulate_alerts(df: DataFrame, q_table: DataFrame, fp_rate: Column | float = 0.0) -> DataFrame:
    """State, chosen action, its reward and the action values for given alerts and false-positive rate."""
    rate = F.lit(fp_rate) if isinstance(fp_rate, (int, float)) else fp_rate
    stated = df.withColumn("state", triage_state("predicted_class", "predicted_proba", rate))
    acted = with_greedy_action(stated, q_table)
    return (
        acted.withColumn("action_name", action_name("action"))
        .withColumn("reward", reward("action", "true_label"))
        .select(
            *df.columns,
            "state",
            "action",
            "action_name",
            "reward",
            *[F.round(F.col("q_values")[a], 4).alias(f"q_{ACTION_NAMES[a]}") for a in range(N_ACTIONS)],
        )
    )


# --- summary ----------------------------------------------------------------------------------


def kpi_summary(
    split: DataFrame, n_features: int, label: str = "attack_category", recall_floor: float = DEFAULTS.recall_floor
) -> DataFrame:
    """Split sizes, number of classes and features, recall floor: one row."""
    per_class = split.groupBy(label, "split").agg(F.count("*").alias("n"))
    sizes = [
        F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}") for s in ("train", "val", "test")
    ]
    return per_class.agg(*sizes, F.count_distinct(label).alias("n_classes")).select(
        "*", F.lit(n_features).alias("n_features"), F.lit(recall_floor).alias("recall_floor")
    )


