import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gamelake import session

    s = session.build(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
