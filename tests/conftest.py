import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="starloom-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    s = build_session("local[4]", app="starloom-tests", shuffle_partitions=4, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, default=os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()
