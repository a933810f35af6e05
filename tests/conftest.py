import os
import sys

import pytest

# Python workers import the hooks of the test modules from here.
os.environ["PYTHONPATH"] = os.pathsep.join(
    filter(None, [os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH")]))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from askloom.testing import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Value of a column expression built from one row of named values."""

    def run(expression, schema="text string", *values):
        return spark.createDataFrame([values], schema).select(expression.alias("x")).head()["x"]

    return run
