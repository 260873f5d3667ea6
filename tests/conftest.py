import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    s = local_session(os.environ.get("TEST_CORES", "8"), "millrace-tests")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def small_groups(spark):
    """Every key over 40 rows takes the split paths."""
    from millrace.session import GROUP_ROWS_KEY

    spark.conf.set(GROUP_ROWS_KEY, "40")
    yield spark
    spark.conf.unset(GROUP_ROWS_KEY)


@pytest.fixture(scope="session")
def sf():
    return SF
