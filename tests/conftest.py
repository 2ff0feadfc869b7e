import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ambry.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ambry-test-ckpt-")
    s = build_session("local[4]", app="ambry-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
