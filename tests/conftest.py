import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sorrel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", 4)
    s.sparkContext.setLogLevel("OFF")
    # small data would be merged into one partition, and running sums over several never be tried
    s.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def get(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in t))

    return get
