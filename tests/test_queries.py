"""Every registered query against its SQL twin; the others must at least give rows."""

import checker
import pytest

import __spark_entry__ as contract
from alertloom.plans.catalog import QUERIES
from alertloom.plans.oracle import ORACLES

# only these cannot be stated in SQL: fitted trees and principal components
WITHOUT_SQL = {
    "rf_predict",
    "gbt_ovr_predict",
    "feature_importance",
    "fitted_model_report",
    "fitted_best_model",
    "fitted_overfit_check",
    "fitted_policy_scorecard",
    "pca_reconstruction_error",
    "anomaly_detection_report",
    "detector_score_histogram",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return checker.connect(sf_dir)


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert checker.compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_contract_offers_all():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "policy" and df.count() == 4
