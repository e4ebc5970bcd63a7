import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows as plain tuples, sorted with NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(type(v)), v) for v in t])
