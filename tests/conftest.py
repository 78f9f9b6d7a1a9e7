import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemerge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, folder):
    from tidemerge.queries.base import Tables
    return Tables(spark, folder)


@pytest.fixture
def fresh(spark):
    """A new path for written data."""
    from tidemerge.session import work_path
    return lambda label="t": work_path(spark, f"test-{label}")
