import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


def pytest_sessionstart(session):
    """Columns in test modules need a running session."""
    from quernstone.session import session as start

    s = start(master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__sql__warehouse__dir=tempfile.mkdtemp(), spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()
