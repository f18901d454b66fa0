import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from devicelens.schema import READINGS  # noqa: E402
from devicelens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="devicelens-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4, app="devicelens-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def readings(spark):
    """Build a readings frame from (tenant, type, device, value, ms) tuples."""
    from devicelens.functions.timecols import ms_to_ts

    def make(rows):
        return spark.createDataFrame(rows, READINGS).withColumn("ts", ms_to_ts("time_stamp"))

    return make


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="devicelens-test-")
