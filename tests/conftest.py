import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from knownwhen.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="knownwhen-tests-")
    session = local_session("tests", cores="8", memory="8g", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture
def small():
    return SMALL


@pytest.fixture
def medium():
    return MEDIUM
