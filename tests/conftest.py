import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__  # noqa: E402, F401  ships the package to the tasks
from check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("8", "6g")
    yield spark
    spark.stop()
