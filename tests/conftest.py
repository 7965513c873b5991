import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from modeforge.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, memory="4g")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "event_type", "value")
