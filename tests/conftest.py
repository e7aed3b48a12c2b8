import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillpoint.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="tillpoint-tests", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tillpoint-test-")


SF_SMALL = "/root/testdata/sf0.001"
