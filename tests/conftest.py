import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelspark.session import local_session  # noqa: E402
from reelspark.streaming import STATE_STORE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="8g")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    yield session
    session.stop()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def as_rows():
    return rows
