import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from anemos.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(hours: float) -> datetime:
    return START + timedelta(hours=hours)


def rows(df, *names):
    """Sorted tuples of the named columns."""
    return sorted([tuple(r) for r in df.select(*names).collect()], key=lambda t: tuple((x is None, x) for x in t))
