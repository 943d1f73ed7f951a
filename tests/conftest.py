import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import build_session
    ckpt = tempfile.mkdtemp(prefix="cartwheel-test-ckpt-")
    s = build_session("local[4]", "cartwheel-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_spark(spark):
    """A fresh folder under the session's checkpoint folder."""
    from cartwheel.session import checkpoint_root
    return tempfile.mkdtemp(prefix="t-", dir=checkpoint_root(spark))


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
