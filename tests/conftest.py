import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stratus.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="stratus-tests")
    yield s
    s.stop()
