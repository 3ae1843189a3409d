import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from duskwatch.session import local_session, ship_package

    s = local_session("tests", "8", 4)
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a list of plain tuples, sorted."""

    def get(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple(str(x) for x in t))

    return get
