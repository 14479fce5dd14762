import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from boardsmith.session import get_spark

    s = get_spark("local[4]", app="boardsmith-tests", conf={"spark.sql.shuffle.partitions": "8"})
    # Tests own the session, so they may pick the checkpoint folder (only where it is unset).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="boardsmith-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
