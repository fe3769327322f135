import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("strata-tests", master="local[4]", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
