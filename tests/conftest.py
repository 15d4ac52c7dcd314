import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tabsieve.session import local_session
    s = local_session(cores="4", shuffle_partitions=4, app="tabsieve-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return SF001
