import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from tidelog import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (builder("tests").master("local[8]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "6g")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidelog-tests-"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))
