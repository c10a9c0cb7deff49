import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-")
    s = get_session("local[4]", app="ledgerlens-tests", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlens-test-")
