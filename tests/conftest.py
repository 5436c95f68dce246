import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", name="tidemark-tests")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """DataFrame from tuples and a DDL schema."""

    def build(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    return build
