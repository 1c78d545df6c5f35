import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from abiflow.session import local_session, shared_dir

    s = local_session(cores="*", shuffle_partitions=8, app="abiflow-tests")
    shared_dir(s)
    yield s
