import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tagtide.session import local_session

    session = local_session(8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
