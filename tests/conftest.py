import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from candlemill.session import local_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests")


@pytest.fixture
def folder(spark):
    return scratch_dir(spark, "test")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
