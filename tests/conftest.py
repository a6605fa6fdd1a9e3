import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from layerwise.session import get_session

    session = get_session("layerwise-tests", master="local[4]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)
