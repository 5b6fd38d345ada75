"""Boundary values of the row expressions."""

import pytest
from pyspark.sql import functions as F

from alertloom.functions import expressions as fx
from alertloom.operators import triage
from alertloom.params import DEFAULTS, Costs, N_STATES


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_confidence_cuts_are_left_closed(spark):
    values = [0.0, 0.4999, 0.50, 0.7499, 0.75, 0.8999, 0.90, 1.0]
    assert column(spark, [(v,) for v in values], "p double", fx.confidence_bucket("p")) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_fp_rate_cuts_are_left_closed(spark):
    values = [0.0, 0.0999, 0.10, 0.2999, 0.30, 1.0]
    assert column(spark, [(v,) for v in values], "p double", fx.fp_rate_bucket("p")) == [0, 0, 1, 1, 2, 2]


def test_states_are_a_bijection(spark):
    df = spark.range(N_STATES).select(F.col("id").cast("int").alias("s"))
    back = df.select("s", fx.encode_state(*fx.decode_state("s")).alias("t"))
    assert back.filter("s <> t").count() == 0


def test_threshold_policy_at_the_threshold(spark):
    rows = [(1, 0.85), (0, 0.85), (1, 0.8499), (0, 0.8499)]
    assert column(spark, rows, "c int, p double", fx.policy_threshold("c", "p")) == [0, 2, 1, 1]


def test_heuristic_policy_bounds(spark):
    rows = [(1, 0.85), (1, 0.86), (0, 0.60), (0, 0.59), (1, 0.59)]
    assert column(spark, rows, "c int, p double", fx.policy_heuristic("c", "p")) == [2, 0, 2, 1, 1]


def test_rewards(spark):
    rows = [(a, t) for a in (0, 1, 2) for t in ("Normal", "DoS", "U2R")]
    got = column(spark, rows, "a int, t string", fx.reward("a", "t"))
    assert got == [1.0, -20.0, -15.0, 0.0, -5.0, -5.0, -3.0, -1.0, -1.0]


def test_rewards_follow_the_cost_parameters(spark):
    costs = Costs(fn_attack=30, fn_dos=50, fp_normal=7, escalation=2, tn_saving=-4)
    rows = [(0, "Normal"), (0, "DoS"), (1, "DoS"), (2, "Normal"), (2, "R2L")]
    assert column(spark, rows, "a int, t string", fx.reward("a", "t", costs)) == [4.0, -50.0, -10.0, -9.0, -2.0]


@pytest.mark.parametrize(
    "values, expected", [([0.0, 0.0, 0.0], 0), ([1.0, 1.0, 0.0], 0), ([0.0, 2.0, 2.0], 1), ([-1.0, -2.0, 3.0], 2)]
)
def test_first_argmax_wins_ties(spark, values, expected):
    assert column(spark, [(values,)], "q array<double>", fx.first_argmax("q")) == [expected]


def test_unseen_state_is_ignored(spark):
    q = spark.createDataFrame([(3, 2, 5.0), (4, 0, -1.0)], "state int, action int, q double")
    states = spark.createDataFrame([(3,), (4,), (59,)], "state int")
    got = {r.state: r.action for r in triage.with_greedy_action(states, q).collect()}
    assert got == {3: 2, 4: 1, 59: 0}  # state 4: -1 for ignore, 0 for the others


def test_unknown_and_missing_attack_types(spark):
    rows = [("neptune",), ("normal",), ("never_heard",), (None,)]
    assert column(spark, rows, "t string", fx.attack_category("t")) == ["DoS", "Normal", "Unknown", "Unknown"]


def test_label_lookups_out_of_range(spark):
    assert column(spark, [(0,), (4,), (5,), (None,)], "i int", fx.label_name("i")) == ["DoS", "U2R", None, None]
    assert column(spark, [("Normal",), ("Unknown",)], "n string", fx.label_position("n")) == [1, None]


def test_epsilon_schedule(spark):
    got = column(spark, [(15,), (0,), (5000,)], "k int", fx.epsilon_after("k"))
    assert got[0] == pytest.approx(0.9275689688183278) and got[1] == 1.0 and got[2] == DEFAULTS.epsilon_end


def test_epsilon_greedy_ends(spark):
    df = spark.range(2000).select("id", F.lit(2).alias("g"))
    never = df.filter(fx.epsilon_greedy("id", "g", F.lit(0.0)) != 2).count()
    shares = df.groupBy(fx.epsilon_greedy("id", "g", F.lit(1.0)).alias("a")).count().collect()
    assert never == 0 and {r.a for r in shares} == {0, 1, 2} and all(560 < r["count"] < 780 for r in shares)


def test_draws_do_not_depend_on_partitioning(spark):
    df = spark.range(5000)
    one = df.repartition(1).select("id", fx.hash_draw("id", "x").alias("u"))
    many = df.repartition(13).select("id", fx.hash_draw("id", "x").alias("v"))
    assert one.join(many, "id").filter("u <> v").count() == 0
    assert one.agg(F.avg("u")).first()[0] == pytest.approx(0.5, abs=0.02)
