import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mirrorspan.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    from mirrorspan.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "store"))


def bag(df):
    """Rows as a sorted list, for comparison without order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
