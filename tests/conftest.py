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
    from riskframe.session import build_session
    s = build_session("local[4]", app="riskframe-tests", shuffle_partitions=8, driver_memory="8g")
    # tests set their own checkpoint folder only because none is configured
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-test-ckpt-"))
    yield s
    s.stop()
