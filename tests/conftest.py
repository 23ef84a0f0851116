import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from citymotion.session import local_session

    s = local_session(4, app="citymotion-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return tmp_path
