import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from talewright.session import local_session

    s = local_session(4, 8, app="talewright-tests")
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
