"""Column expressions. Everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertloom.params import (
    ACTION_NAMES,
    ATTACK_CATEGORIES,
    CONFIDENCE_CUTS,
    Costs,
    DEFAULTS,
    DOS,
    ESCALATE,
    FP_RATE_CUTS,
    HEURISTIC_IGNORE,
    HEURISTIC_MONITOR,
    IGNORE,
    LABELS,
    MONITOR,
    NORMAL,
    NORMAL_INDEX,
    N_ACTIONS,
    N_CONFIDENCE,
    N_FP,
    UNKNOWN,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- deterministic draws ---------------------------------------------------


def hash_draw(key: Column | str, salt: str | Column, part: int = 0) -> Column:
    """Uniform number in [0, 1) that depends only on the key and the salt.

    Unlike ``rand(seed)`` it does not depend on how the input is partitioned,
    so a task that is run again gives the same rows. One digest holds four
    independent draws, numbered by ``part``.
    """
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat(_col(key).cast("string"), F.lit(":"), salt))
    return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def split_name(key: Column | str, salt: str = "split", train=DEFAULTS.train_share, val=DEFAULTS.val_share) -> Column:
    """train / val / test by hash of a stable key."""
    u = hash_draw(key, salt)
    return F.when(u < train, "train").when(u < train + val, "val").otherwise("test")


def fold_index(key: Column | str, k: int, salt: str = "fold") -> Column:
    return F.floor(hash_draw(key, salt) * k).cast("int")


# --- labels ----------------------------------------------------------------


def attack_category(attack_type: Column | str) -> Column:
    """Category of a raw attack type, ``Unknown`` where it is not mapped."""
    mapping = F.create_map(*[F.lit(x) for pair in ATTACK_CATEGORIES.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, _col(attack_type)), F.lit(UNKNOWN))


def label_name(index: Column | str, labels: Sequence[str] = LABELS) -> Column:
    """Class name of a class index; null outside the known range."""
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), _col(index).cast("int") + 1)


def label_position(name: Column | str, labels: Sequence[str] = LABELS) -> Column:
    """Class index of a class name; null for an unknown name."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), _col(name))
    return F.when(pos > 0, (pos - 1).cast("int"))


def action_name(action: Column | str) -> Column:
    return label_name(action, ACTION_NAMES)


def is_attack(true_label: Column | str) -> Column:
    return _col(true_label) != NORMAL


# --- triage state ----------------------------------------------------------


def _bucket(value: Column | str, cuts: Sequence[float]) -> Column:
    expr = None
    for i, cut in enumerate(cuts):
        cond = _col(value) < cut
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr.otherwise(len(cuts))


def confidence_bucket(proba: Column | str) -> Column:
    return _bucket(proba, CONFIDENCE_CUTS)


def fp_rate_bucket(rate: Column | str) -> Column:
    return _bucket(rate, FP_RATE_CUTS)


def encode_state(predicted_class: Column | str, confidence: Column | str, fp: Column | str) -> Column:
    """State number from class index, confidence bucket and false-positive bucket."""
    return (_col(predicted_class) * (N_CONFIDENCE * N_FP) + _col(confidence) * N_FP + _col(fp)).cast("int")


def triage_state(predicted_class: Column | str, proba: Column | str, fp_rate: Column | str) -> Column:
    return encode_state(predicted_class, confidence_bucket(proba), fp_rate_bucket(fp_rate))


def decode_state(state: Column | str) -> tuple[Column, Column, Column]:
    """(class index, confidence bucket, false-positive bucket) of a state number."""
    s = _col(state)
    return (
        F.floor(s / (N_CONFIDENCE * N_FP)).cast("int"),
        (F.floor(s / N_FP) % N_CONFIDENCE).cast("int"),
        (s % N_FP).cast("int"),
    )


# --- prices ----------------------------------------------------------------


def reward(action: Column | str, true_label: Column | str, costs: Costs = DEFAULTS.costs) -> Column:
    """Reward of an action given the true class; cost is its negative.

    A monitored attack costs a third of a missed one whatever its class, and an
    escalation always pays the review cost.
    """
    a, attack = _col(action), is_attack(true_label)
    ignored = (
        F.when(~attack, float(-costs.tn_saving))
        .when(_col(true_label) == DOS, float(-costs.fn_dos))
        .otherwise(float(-costs.fn_attack))
    )
    monitored = F.when(attack, -costs.fn_attack / 3.0).otherwise(0.0)
    escalated = F.when(attack, float(-costs.escalation)).otherwise(float(-costs.escalation - costs.fp_normal))
    return F.when(a == IGNORE, ignored).when(a == MONITOR, monitored).otherwise(escalated)


def confusion_role(action: Column | str, true_label: Column | str) -> Column:
    """TP / FP for escalated alerts, FN / TN for the others (monitoring is a miss)."""
    attack = is_attack(true_label)
    return (
        F.when((_col(action) == ESCALATE) & attack, "TP")
        .when(_col(action) == ESCALATE, "FP")
        .when(attack, "FN")
        .otherwise("TN")
    )


def is_false_positive(action: Column | str, true_label: Column | str) -> Column:
    return (_col(action) == ESCALATE) & ~is_attack(true_label)


# --- policies --------------------------------------------------------------


def policy_escalate_all() -> Column:
    return F.lit(ESCALATE)


def policy_threshold(
    predicted_class: Column | str, proba: Column | str, threshold: float = DEFAULTS.threshold
) -> Column:
    """Confident normal -> ignore, confident attack -> escalate, else monitor."""
    sure = _col(proba) >= threshold
    return (
        F.when(sure & (_col(predicted_class) == NORMAL_INDEX), IGNORE).when(sure, ESCALATE).otherwise(MONITOR)
    )


def policy_argmax(predicted_class: Column | str) -> Column:
    return F.when(_col(predicted_class) == NORMAL_INDEX, IGNORE).otherwise(ESCALATE)


def policy_heuristic(predicted_class: Column | str, proba: Column | str) -> Column:
    return (
        F.when((_col(predicted_class) == NORMAL_INDEX) & (_col(proba) > HEURISTIC_IGNORE), IGNORE)
        .when(_col(proba) < HEURISTIC_MONITOR, MONITOR)
        .otherwise(ESCALATE)
    )


def first_argmax(values: Column | str) -> Column:
    """Position of the largest element; the first one wins ties."""
    v = _col(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def _step_salt(salt: str | Column) -> Column:
    return F.concat(F.lit("step"), F.lit(salt) if isinstance(salt, str) else salt)


def random_action(key: Column | str, salt: str | Column = "0") -> Column:
    return F.floor(hash_draw(key, _step_salt(salt), part=1) * N_ACTIONS).cast("int")


def epsilon_greedy(
    key: Column | str, greedy: Column | str, epsilon: Column | float, salt: str | Column = "0"
) -> Column:
    """Random action with probability epsilon, else the greedy one.

    Both draws come from the key, so the choice is the same on every run.
    """
    return F.when(hash_draw(key, _step_salt(salt)) < epsilon, random_action(key, salt)).otherwise(_col(greedy))


def epsilon_after(
    epoch: Column | str,
    start: float = DEFAULTS.epsilon_start,
    end: float = DEFAULTS.epsilon_end,
    decay: float = DEFAULTS.epsilon_decay,
) -> Column:
    """Exploration rate after the given number of decays."""
    return F.greatest(F.lit(end), F.lit(start) * F.pow(F.lit(decay), _col(epoch)))


# --- anomaly ---------------------------------------------------------------


def anomaly_score(error: Column | str, max_error: Column | float) -> Column:
    return _col(error) / ((F.lit(max_error) if isinstance(max_error, (int, float)) else max_error) + 1e-9)
