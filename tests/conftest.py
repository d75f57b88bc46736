import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

@pytest.fixture(scope="session")
def spark():
    from lotwright.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="lotwright-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lotwright-test-ckpt-"))
    yield s

