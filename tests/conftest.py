import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("HEBDO_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="hebdo-test-ckpt-"))
    from hebdo.session import local_session
    s = local_session("*", shuffle_partitions=8, app="hebdo-tests", driver_memory="4g")
    yield s
    s.stop()
