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
    from ratewise.session import build_session, checkpoint_root, clear_scratch
    s = build_session("local[*]", 8, "ratewise-tests")
    # Tests only: a checkpoint folder of our own when the session names none.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ratewise-test-ckpt-"))
    checkpoint_root(s)
    yield s
    clear_scratch(s)


@pytest.fixture()
def tmp_uri(spark):
    from ratewise.session import scratch_path
    return lambda name: scratch_path(spark, name)
