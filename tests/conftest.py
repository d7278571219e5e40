import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from talentlake.session import build_session, shared_dir

    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="talentlake-test-ckpt-")})
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="talentlake-test-")
