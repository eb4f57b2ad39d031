import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gaugeflow.session import get_session
    s = get_session("local[2]", 4, app_name="gaugeflow-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
