import sys

import pytest

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from tessitura.operators.scans import MAX_ROWS_CONF  # noqa: E402
from tessitura.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tests", "8g")
    yield s
    s.stop()


@pytest.fixture
def tiny_tasks(spark):
    """Make every key with more than seven rows hot."""
    spark.conf.set(MAX_ROWS_CONF, "7")
    yield
    spark.conf.unset(MAX_ROWS_CONF)
