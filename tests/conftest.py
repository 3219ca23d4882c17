import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from waymark.session import local_session
    s = local_session("*", 8, app="waymark-tests")
    # Tests run locally: give the session its own checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lake001(spark):
    from waymark.plans.lake import Lake
    return Lake(spark, SF001)


@pytest.fixture(scope="session")
def lake01(spark):
    from waymark.plans.lake import Lake
    return Lake(spark, SF01)
