import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orrery.session import build_session
    scratch = tempfile.mkdtemp(prefix="orrery-test-")
    s = build_session("local[4]", app="orrery-tests", shuffle_partitions=4,
                      extra={"spark.local.dir": scratch,
                             "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmpdir_session():
    return tempfile.mkdtemp(prefix="orrery-files-")
