import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]


@pytest.fixture(scope="session")
def spark():
    from plantmetrics.session import local_session
    s = local_session(4, 4, app="plantmetrics-tests")
    yield s
    s.stop()
