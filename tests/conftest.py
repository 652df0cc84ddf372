import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quakeframe.session import local_session

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = local_session(os.environ.get("TEST_CORES", "*"), 8, scratch)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
