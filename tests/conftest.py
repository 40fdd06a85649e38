import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickwise.session import local_session
    ck = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = local_session(cores="*", shuffle_partitions=8, checkpoint=ck)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.harness import duck
    return duck(SF_SMALL)
