import os
import sys

import pytest
from small import SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from procmetrics.session import local_session

    os.environ["PROCMETRICS_SCRATCH"] = str(tmp_path_factory.mktemp("scratch"))
    s = local_session("tests", 8, shuffle=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    from oracle import connect

    return connect(SMALL)
