import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.schema import BARS  # noqa: E402
from tickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    """Daily bars of one or more series from lists of closes (or of o, h, l, c)."""

    def make(start=dt.date(2020, 1, 1), **series):
        rows = []
        for pair, values in series.items():
            for i, v in enumerate(values):
                o, h, l, c = v if isinstance(v, tuple) else (v, v, v, v)
                rows.append((pair, start + dt.timedelta(days=i), o, h, l, c))
        return spark.createDataFrame(rows, BARS)

    return make


def values(df, column, order="date", **where):
    """A column in series order."""
    for k, v in where.items():
        df = df.filter(df[k] == v)
    return [r[column] for r in sorted(df.collect(), key=lambda r: r[order])]
