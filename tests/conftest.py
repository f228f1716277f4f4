import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    return local_session(4, shuffle_partitions=4, app="tidemark-tests")


@pytest.fixture(scope="session")
def duck():
    from tests.parity import duck as connect

    return connect(SF_DIR)


@pytest.fixture
def frame(spark):
    """``frame(rows, ddl)`` builds a small DataFrame."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


def rows(df):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
