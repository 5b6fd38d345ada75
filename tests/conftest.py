import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from alertloom.plans import catalog  # noqa: E402
from alertloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def small_searches():
    """The published grid of the boosted model takes minutes; the registered queries use it, the tests of their wiring need not."""
    catalog.BOOSTED_SEARCH.update(iterations=(2, 4), depths=(2, 3), folds=2)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
