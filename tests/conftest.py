import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from casewise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def rows():
    """Collect as a sorted list of tuples."""
    def collect(df, *columns):
        frame = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in frame.collect()), key=repr)

    return collect
