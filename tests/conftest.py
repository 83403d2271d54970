import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesops.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    yield session


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df):
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
