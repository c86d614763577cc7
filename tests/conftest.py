"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from foliant.runtime import session

    s = session(4, 4)
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])
