import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8)
    # tests run in local mode: give the session its own checkpoint folder (a cluster names a shared one)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quarry-test-")
