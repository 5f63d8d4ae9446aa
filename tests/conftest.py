import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from newsgraph.session import ensure_checkpoint_dir, get_session
    s = get_session("local[*]", "newsgraph-tests", shuffle_partitions=8)
    # tests own their checkpoint folder (the cluster's spark.checkpoint.dir is unset here)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ng-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ng-test-")
