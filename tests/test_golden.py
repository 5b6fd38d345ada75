"""Published cost and weight figures, priced again from the counts behind them."""

import pytest
from pyspark.sql import functions as F

from alertloom.operators import prepare, triage

SCHEMA = "policy string, true_label string, action int, n long"


def counts(policy, attacks, tp, fp, ignored_normal, ignored, ignored_dos, monitored_normal, monitored):
    rows = [
        (policy, "Probe", 2, tp),
        (policy, "Normal", 2, fp),
        (policy, "Normal", 0, ignored_normal),
        (policy, "DoS", 0, ignored_dos),
        (policy, "R2L", 0, ignored - ignored_dos),
        (policy, "Normal", 1, monitored_normal),
        (policy, "DoS", 1, monitored),
    ]
    assert tp + ignored + monitored == attacks
    return [r for r in rows if r[3]]


# policy, counts..., then COT, COT per alert, recall, precision, F1, share ignored / monitored / escalated
GOLDEN = [
    (("escalate_all val", 8688, 8688, 10092, 0, 0, 0, 0, 0), (38964.0, 2.0748, 1.0, 0.4626, 0.6326, 0.0, 0.0, 1.0)),
    (("escalate_all test", 8595, 8595, 9872, 0, 0, 0, 0, 0), (38211.0, 2.0692, 1.0, 0.4654, 0.6352, 0.0, 0.0, 1.0)),
    (("argmax val", 8688, 8670, 74, 10018, 18, 2, 0, 0), (-846.0, -0.045, 0.9979, 0.9915, 0.9947, 0.5344, 0.0, 0.4656)),
    (("argmax test", 8595, 8577, 72, 9800, 18, 0, 0, 0), (-737.0, -0.0399, 0.9979, 0.9917, 0.9948, 0.5317, 0.0, 0.4683)),
    (("threshold val", 8688, 8332, 4, 8566, 0, 0, 1522, 356), (1558.0, 0.083, 0.959, 0.9995, 0.9789, 0.4561, 0.1, 0.4439)),
    (("threshold test", 8595, 8215, 2, 8397, 0, 0, 1473, 380), (1724.0, 0.0934, 0.9558, 0.9998, 0.9773, 0.4547, 0.1003, 0.445)),
]


@pytest.mark.parametrize("case", GOLDEN, ids=lambda c: c[0][0])
def test_published_scorecards(spark, case):
    row = triage.scorecard(spark.createDataFrame(counts(*case[0]), SCHEMA)).first()
    assert tuple(row)[1:9] == case[1] and row.recall_OK


def test_scorecard_from_alert_rows(spark):
    """The same through single alerts and the policies themselves."""
    spec = [("Probe", 0, 0.9, 8577), ("Normal", 2, 0.7, 72), ("Normal", 1, 0.8, 9800), ("U2R", 1, 0.95, 18)]
    kinds = spark.createDataFrame(spec, "true_label string, predicted_class int, predicted_proba double, n int")
    alerts = kinds.withColumn("i", F.explode(F.sequence(F.lit(1), "n")))
    report = {r.policy: r for r in triage.policy_comparison(alerts, triage.baseline_policies()).collect()}
    assert report["argmax"].COT == -737.0 and report["escalate_all"].COT == 38211.0
    assert report["argmax"].recall_sistema == 0.9979 and report["escalate_all"].precision == 0.4654


def test_scorecard_without_attacks_or_escalations(spark):
    no_attack = triage.scorecard(spark.createDataFrame([("p", "Normal", 0, 10)], SCHEMA)).first()
    assert (no_attack.recall_sistema, no_attack.precision, no_attack.COT) == (1.0, 1.0, -10.0)
    nothing_found = triage.scorecard(spark.createDataFrame([("p", "DoS", 1, 4)], SCHEMA)).first()
    assert (nothing_found.recall_sistema, nothing_found.precision, nothing_found.f1_binario) == (0.0, 1.0, 0.0)
    assert not nothing_found.recall_OK


def test_published_class_weights(spark):
    sizes = {"Normal": 47379, "DoS": 32368, "Probe": 8249, "R2L": 698, "U2R": 32}
    expected = {"Normal": 0.3745, "DoS": 0.5482, "Probe": 2.1512, "R2L": 25.4229, "U2R": 554.5375}
    rows = spark.createDataFrame(list(sizes.items()), "attack_category string, n int").select(
        "attack_category", F.explode(F.sequence(F.lit(1), "n"))
    )
    weights = prepare.class_weights(rows)
    assert {r.attack_category: r.weight for r in weights.collect()} == expected
    by_index = {r.label: r.weight for r in prepare.class_weight_map(weights).collect()}
    assert by_index == {1: 0.3745, 0: 0.5482, 2: 2.1512, 3: 25.4229, 4: 554.5375}


def test_situations_add_up_to_the_scorecard(spark):
    rows = spark.createDataFrame(counts(*GOLDEN[4][0]), SCHEMA).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    total = triage.situations(rows).agg(F.sum("total_cost")).first()[0]
    assert total == pytest.approx(1558.0)


def test_best_valid_policy_needs_the_recall_floor(spark):
    cards = triage.scorecard(
        spark.createDataFrame(
            [("cheap", "Normal", 0, 100), ("cheap", "U2R", 1, 1), ("safe", "Normal", 2, 100), ("safe", "U2R", 2, 1)], SCHEMA
        )
    )
    assert [r.policy for r in triage.best_valid_policy(cards).collect()] == ["safe"]
    savings = {r.policy: r.savings for r in triage.savings_vs_baseline(cards.replace("safe", "escalate_all")).collect()}
    assert savings == {"cheap": 396.0, "escalate_all": 0.0}
