import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__  # noqa: E402,F401
from surveyloom.plans.holding import release_all  # noqa: E402
from surveyloom.plans.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(int(os.environ.get("TEST_CPUS", "8")), "surveyloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


@pytest.fixture(autouse=True)
def free_tables():
    yield
    release_all()
