import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bazaar.session import get_spark
    s = get_spark("local[4]", app="bazaar-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="bazaar-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="bazaar-test-")
