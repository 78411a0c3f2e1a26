import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridmill.session import local_session, scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g", 4)
    yield session
    session.stop()


@pytest.fixture
def work(spark):
    """A new folder below the shared one; files in it are reachable by plain path in local mode."""
    return scratch(spark, "test").removeprefix("file://").replace("file:/", "/")


def rows(df, *cols):
    """Sorted plain tuples of a result."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False,) for v in r))
