import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from trackloom.session import local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables are not available")
    return FOLDER
