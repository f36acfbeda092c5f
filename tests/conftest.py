import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adlens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(app="adlens-tests", master="local[*]", shuffle_partitions=8)
    # tests run in local mode: a private checkpoint folder is fine here
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="adlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="adlens-test-")
