import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickmart.conf import ensure_checkpoint_dir, get_session
    from clickmart.plans import materialize
    s = get_session("local[4]", 4, app_name="clickmart-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickmart-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    materialize.drop_tables(s)
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
