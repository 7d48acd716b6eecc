import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fraudlake.session import build_session, checkpoint_root

    s = build_session(
        master="local[4]",
        shuffle_partitions=4,
        extra_conf={"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s, tempfile.mkdtemp(prefix="fraudlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="fraudlake-test-")
