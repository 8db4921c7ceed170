import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from millrace import session as sessions  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = sessions.build_session("tests", 8)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def path(spark):
    """A fresh folder path in the shared scratch folder."""
    return sessions.scratch(spark, "test")


@pytest.fixture
def database(spark):
    from millrace.plans.inputs import new_database

    return new_database(spark)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def plan():
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
