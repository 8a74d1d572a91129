import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from webloom.session import build_session
    tmp = tempfile.mkdtemp(prefix="webloom-test-")
    s = build_session("local[4]", app="webloom-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": os.path.join(tmp, "warehouse"),
                             "spark.checkpoint.dir": os.path.join(tmp, "ckpt")})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path(tmp_path):
    return str(tmp_path)
