import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from botsieve.session import get_session
    ckpt = tempfile.mkdtemp(prefix="botsieve-test-")
    session = get_session("local[8]", 8, extra={"spark.checkpoint.dir": ckpt})
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from botsieve.session import work_dir
    return work_dir(spark, "test")
