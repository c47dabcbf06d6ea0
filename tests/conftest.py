import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path.insert(0, ROOT)
# Python workers unpickle test-defined classes (stub models): let them import tests.
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from cutpoint.session import build_session
    s = build_session("local[4]", app="cutpoint-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
