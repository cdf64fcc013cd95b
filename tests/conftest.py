import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from countypanel.session import local_session  # noqa: E402

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "countypanel-tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Builds a frame from rows and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
