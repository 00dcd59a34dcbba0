import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import checkpoint_dir, get_session
    shared = tempfile.mkdtemp(prefix="kpiloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    s = get_session("local[4]", app_name="kpiloom-tests", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="kpiloom-test-", dir=os.environ.get("TMPDIR", "/tmp"))
