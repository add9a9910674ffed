import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from microblog.config import local_session

    s = local_session(app="microblog-tests", cpus=8, shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from tools.oracle_check import duck

    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_check():
    from tools.oracle_check import duck

    return duck(SF_CHECK)
